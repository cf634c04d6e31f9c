"""Substring dedup by recompression: equal runs of words get equal symbols.

Every document is parsed in rounds.  A round names maximal runs of one symbol
and then pairs of neighbours; names are 64-bit content hashes, so every task
gives the same substring the same name without a naming table.  For each
symbol the parse keeps the span of words that decided it: a symbol whose span
lies inside a window is an *interior* symbol, equal in every occurrence of that
window whatever surrounds it.  Each ``WINDOW``-word window is filed under its
canonical interior symbol (the highest level, then the smallest name), and
consecutive windows under one symbol form a piece.

Pieces, about one per twelve words, are what Spark shuffles.  Equal pieces are
repeats at once; a symbol with several different pieces is verified window by
window, on one representative per piece.  Both comparisons use 128 bits of
content (symbol name and content hash), not the symbol alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import arrow_map, keep, rekeyed, release, slices, texts_of

WINDOW = 50
ROUNDS = 3           # levels above words; more make longer but context-bound symbols
BATCH = 1 << 18      # bytes of text parsed together
SLICE = 1 << 16      # windows of one document parsed together; what a window files under does not depend on it
U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
INVERSE = U(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijective 64-bit scrambler (splitmix finaliser)."""
    x = x + U(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Content:
    """Content hashes of any word span of one array of word names."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        powers = np.full(n, BASE)
        powers[:1] = 1
        self.undo = np.full(n + 1, INVERSE)
        self.undo[:1] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.undo, out=self.undo)
        self.sums = np.zeros(n + 1, U)
        np.add.accumulate(mix(words, 7) * powers, out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of words ``lo`` to ``hi`` (exclusive)."""
        return (self.sums[hi] - self.sums[lo]) * self.undo[lo]


def name_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), U, len(words))


def parse(name: np.ndarray, wall: np.ndarray, rounds: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (name, first, last): symbols and the span of words that decided each.

    ``wall`` marks separators between documents; they join nothing, and no
    symbol decided by one lies inside a window.
    """
    lo = np.arange(len(name))
    hi = lo.copy()
    out = [(name, lo, hi)]
    for level in range(1, rounds + 1):
        # runs: whether a symbol stands alone depends on both neighbours
        first = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | wall[1:] | wall[:-1]])
        last = np.r_[first[1:], len(name)] - 1
        length = last - first + 1
        lo, hi = lo[np.maximum(first - 1, 0)], hi[np.minimum(last + 1, len(name) - 1)]
        name, wall = name[first], wall[first]
        many = length > 1
        name = np.where(many, mix(name ^ mix(length.astype(U), 2), 3 * level), name)
        # pairs: a left symbol joins a right symbol that follows it
        left = (mix(name, 1000 + level) & U(1)) == 0
        pair = np.flatnonzero(left[:-1] & ~left[1:] & ~wall[:-1] & ~wall[1:])
        stays = np.ones(len(name), bool)
        stays[pair + 1] = False
        new, nlo, nhi = name.copy(), lo.copy(), hi.copy()
        new[pair] = mix(name[pair] * U(3) + mix(name[pair + 1], 5), 3 * level + 1)
        nhi[pair] = hi[pair + 1]
        alone = stays.copy()
        alone[pair] = False
        i = np.flatnonzero(alone & left)
        nhi[i] = hi[np.minimum(i + 1, len(hi) - 1)]
        i = np.flatnonzero(alone & ~left)
        nlo[i] = lo[np.maximum(i - 1, 0)]
        name, lo, hi, wall = new[stays], nlo[stays], nhi[stays], wall[stays]
        out.append((name, lo, hi))
    return out


def file_windows(levels, n: int, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(level, symbol index) of the canonical interior symbol of the window at each of ``starts``."""
    level = np.full(len(starts), -1, np.int8)
    symbol = np.zeros(len(starts), np.int64)
    open_ = np.arange(len(starts))
    for k in range(len(levels) - 1, -1, -1):
        name, lo, hi = levels[k]
        order = mix(name, 77)
        a = np.concatenate([[0], np.cumsum(np.bincount(lo, minlength=n))])[starts[open_]]
        b = np.cumsum(np.bincount(hi, minlength=n))[starts[open_] + window - 1]
        got = np.flatnonzero(b > a)
        a, b, at = a[got], b[got], open_[got]
        best = a.copy()
        live = np.arange(len(a))
        step = 1
        while True:
            live = live[a[live] + step < b[live]]
            if not len(live):
                break
            j = a[live] + step
            better = order[j] < order[best[live]]
            best[live[better]] = j[better]
            step += 1
        level[at], symbol[at] = k, best
        open_ = np.delete(open_, got)
        if not len(open_):
            break
    return level, symbol


def pieces_of(docs: list[bytes], window: int, rounds: int = ROUNDS):
    """Arrays (document index, first window, windows, symbol, content) of some documents' pieces."""
    words, owner = [b""], []
    for i, d in enumerate(docs):
        w = d.split()
        for s in range(0, len(w) - window + 1, SLICE):
            part = w[s:s + SLICE + window - 1]
            owner.append((i, s, len(words), len(part)))
            words += part
            words.append(b"")
    if not owner:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(U), z.astype(U)
    name = name_words(words)
    wall = np.zeros(len(words), bool)
    ends = np.array([at + n for _, _, at, n in owner])
    wall[0] = wall[ends] = True
    levels = parse(name, wall, rounds)
    index, skipped, base, count = (np.array(x) for x in zip(*owner))
    count = count - window + 1
    doc = np.repeat(np.arange(len(owner)), count)
    starts = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + base[doc]
    level, symbol = file_windows(levels, len(words), starts, window)
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (level[1:] != level[:-1]) | (symbol[1:] != symbol[:-1])])
    size = np.diff(np.r_[new, len(doc)])
    content = Content(name)
    key, lo = np.zeros(len(new), U), np.zeros(len(new), np.int64)
    for k, (sym, slo, shi) in enumerate(levels):
        at = np.flatnonzero(level[new] == k)
        s = symbol[new[at]]
        key[at] = mix(sym[s] ^ mix(content.of(slo[s], shi[s] + 1), 9), k + 1)
        lo[at] = slo[s]
    first = starts[new]
    seg = content.of(first, first + size - 1 + window)
    seg = mix(seg ^ mix((size * 4096 + (lo - first)).astype(U), 11), 13)
    return index[doc[new]], first - base[doc[new]] + skipped[doc[new]], size, key, seg


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and a content mark that tells apart rows that repeat a doc_id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.xxhash64("text").alias("mark"))


def repeat_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, mark, first, n)``: runs of window starts whose words also start in a smaller doc_id."""
    src = _identified(docs).where("doc_id is not null")

    def cut(batch):
        for part in slices(batch, BATCH):
            doc, first, size, key, seg = pieces_of(texts_of(part), window)
            rows = part.select(["doc_id", "mark"]).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32)),
                 pa.array(key.view(np.int64)), pa.array(seg.view(np.int64))],
                names=["doc_id", "mark", "first", "n", "symbol", "content"])

    pieces = keep(src.mapInArrow(
        arrow_map(cut), "doc_id long, mark long, first int, n int, symbol long, content long"), "pieces")
    source = pieces.groupBy("symbol", "content").agg(F.min("doc_id").alias("source")).select(
        rekeyed("symbol").alias("s"), rekeyed("content").alias("c"), "source")
    several = pieces.groupBy("symbol").agg(
        F.min("content").alias("c1"), F.max("content").alias("c2"), F.min("doc_id").alias("d1"),
        F.max("doc_id").alias("d2")).where("c1 <> c2 and d1 < d2").select(rekeyed("symbol").alias("s2"))
    traced = pieces.join(source, (pieces.symbol == source.s) & (pieces.content == source.c))
    traced = keep(traced.join(several, traced.symbol == several.s2, "left").where(
        "doc_id > source or s2 is not null").select("doc_id", "mark", "first", "n", "symbol", "source"), "traced")
    release(pieces)
    whole = traced.where("doc_id > source").select("doc_id", "mark", "first", "n")
    asked = traced.where("doc_id = source").groupBy("doc_id", "mark").agg(
        F.collect_set(F.struct("first", "n", "symbol")).alias("asked"))    # as long as the text at most
    asked = asked.select(rekeyed("doc_id").alias("d"), F.col("mark").alias("m"), "asked")

    def open_windows(batch):
        for i in range(batch.num_rows):
            ask = batch.column(3)[i].values
            first, n, sym = (ask.field(k).to_numpy() for k in range(3))
            content = Content(name_words(batch.column(1)[i].as_py().encode("utf-8").split()))
            at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            full = np.full(len(at), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full * batch.column(0)[i].as_py()), pa.array(full * batch.column(2)[i].as_py()),
                 pa.array(at.astype(np.int32)), pa.array(np.repeat(sym, n)),
                 pa.array(mix(content.of(at, at + window), 17).view(np.int64))],
                names=["doc_id", "mark", "first", "symbol", "content"])

    windows = src.join(asked, (src.doc_id == asked.d) & (src.mark == asked.m)).select("doc_id", "text", "mark", "asked")
    windows = keep(windows.mapInArrow(
        arrow_map(open_windows), "doc_id long, mark long, first int, symbol long, content long"), "windows")
    least = windows.groupBy("symbol", "content").agg(F.min("doc_id").alias("d1"), F.max("doc_id").alias("d2")).where(
        "d1 < d2").select(rekeyed("symbol").alias("s"), rekeyed("content").alias("c"), "d1")
    single = windows.join(least, (windows.symbol == least.s) & (windows.content == least.c)).where(
        "doc_id > d1").select("doc_id", "mark", "first", F.lit(1).alias("n"))
    return whole.union(single)


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` of every row of ``docs``.

    A word goes when a window of ``window`` consecutive words that covers it
    also starts in a document with a smaller doc_id; windows are judged on the
    input.  Words are runs of ``[^\\x20\\x09-\\x0D]``; kept words are joined by one
    space.  Null or empty texts give no words; rows without a doc_id are kept
    whole and are no one's source; rows that repeat a doc_id are judged each by
    its own text, never against their own id.
    """
    cover = repeat_ranges(docs, window).groupBy("doc_id", "mark").agg(
        F.collect_set(F.struct("first", "n")).alias("gone")).select(
        rekeyed("doc_id").alias("d"), F.col("mark").alias("m"), "gone")
    src = _identified(docs)
    joined = src.join(cover, (src.doc_id == cover.d) & (src.mark == cover.m), "left").select("doc_id", "text", "gone")

    def trim(batch):
        for part in slices(batch, 8 * BATCH):
            total, removed, kept = [], [], []
            for t, g in zip(texts_of(part), part.column(2)):
                words = t.split()
                total.append(len(words))
                if g.is_valid:
                    edge = np.zeros(len(words) + 1, np.int32)
                    first, n = (g.values.field(k).to_numpy() for k in range(2))
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + n + window - 1, -1)
                    stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    removed.append(len(words) - len(stay))
                    words = [words[i] for i in stay]
                else:
                    removed.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(arrow_map(trim), "doc_id long, n_words long, n_removed long, kept_text string")
