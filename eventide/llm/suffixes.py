"""Substring dedup over sorted suffixes of the texts' bytes.

A byte goes when a string of ``length`` bytes that covers it also starts
earlier.  Sorting a suffix for every byte would move each byte a hundred times,
so the suffixes sorted are those at *anchors*: of the short strings (grams)
inside a window of ``length`` bytes the one with the least hash, which equal
windows share at the same place.  Consecutive windows with one anchor form a
slice, sorted as the suffix at its anchor followed by the bytes before it.

Spark samples splitters and range-partitions the suffixes by their bytes (then
document and position, so that a string that a third of all texts hold is cut
into several ranges); every bucket sorts its suffixes by multikey quicksort,
and a group that reaches over a bucket's edge is compared with the one before
it.  Four such passes settle everything:

1. slices by suffix: one equal to an earlier one is settled; the others keep the
   windows that end within their longest match with a neighbour in the order;
2. the rest by reversed prefix: they keep the windows that begin within their
   longest match to the left;
3. what is left of each slice by suffix again: most are now equal to another;
4. the windows still open, each as a suffix of its own.

Slices whose gram no other slice has are dropped beforehand by the gram's
64-bit hash: a hash can only keep too many of them, equality is always found on
bytes.  Whole texts equal to one of a smaller doc_id (by SHA-256) need no slices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import arrow_map, keep_only, rekeyed, release, slices, texts_of

LENGTH = 100
GRAM = 0.32                   # length of a gram as a share of the window
BATCH = 1 << 18               # bytes worked on together
CUT = 1 << 16                 # windows of one text worked on together; no window's anchor depends on it
ROWS = 1 << 12                # values spread out together
PERIODS = range(1, 9)         # strings of these periods repeat inside their own text; found without sorting
PLACE = 20                    # low bits of a gram's hash that give way to its place: batches are shorter than 2**20
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 1 << 64))


def scramble(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijective 64-bit scrambler (splitmix finaliser)."""
    x = x + U(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """The 64-bit hash of the ``k`` bytes at each place of ``data``."""
    n = len(data)
    up, down = np.full(n, BASE), np.full(n, INVERSE)
    up[:1] = down[:1] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    sums = np.zeros(n + 1, U)
    np.add.accumulate(scramble(np.arange(256, dtype=U), 5)[data] * up, out=sums[1:])
    return scramble((sums[k:] - sums[:-k]) * down[:n - k + 1], 9)


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each ``width`` consecutive hashes (the leftmost of equal ones)."""
    key = (hashes >> U(PLACE) << U(PLACE)) | np.arange(len(hashes), dtype=U)
    n = len(key) - width + 1
    blocks = np.concatenate([key, np.full(-len(key) % width, ~U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & U((1 << PLACE) - 1)).astype(np.int64)


def flatten(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``counts[i]`` of them), one after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def cut_slices(data: np.ndarray, first: np.ndarray, count: np.ndarray, length: int, k: int):
    """Slices of the windows ``first .. first + count - 1`` (one range each).

    Arrays (range, start, windows, anchor, gram); starts and anchors are places in ``data``.
    """
    count = np.asarray(count)
    if not count.sum():
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(U)
    hashes = gram_hashes(data, k)
    at = flatten(first, count)
    of = np.repeat(np.arange(len(count)), count)
    anchor = anchors(hashes, length - k + 1)[at]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)])
    return of[new], at[new], np.diff(np.r_[new, len(at)]), anchor[new], hashes[anchor[new]]


def periodic(data: np.ndarray, base: np.ndarray, length: int) -> np.ndarray:
    """At which places of ``data`` a window starts that equals the one a short period before it.

    ``base``: where the texts that lie one after the other in ``data`` start.
    """
    out = np.zeros(len(data), bool)
    for p in PERIODS:
        if len(data) < length + p:
            break
        unlike = data[p:] != data[:-p]
        for i in range(p):    # a text's first bytes have none before them
            unlike[base[(base + i >= p) & (base + i - p < len(unlike))] + i - p] = True
        edge = np.r_[-1, np.flatnonzero(unlike), len(unlike)]
        run = np.diff(edge) - 1
        long = np.flatnonzero(run >= length)
        out[flatten(edge[long] + 1 + p, run[long] - length + 1)] = True
    return out


def turned(data: np.ndarray, start: np.ndarray, count: np.ndarray, anchor: np.ndarray, length: int) -> pa.Array:
    """Each slice's bytes from its anchor on, then those before it."""
    size = count + length - 1
    place = flatten(np.zeros(len(size), np.int64), size) + np.repeat(anchor - start, size)
    wide = np.repeat(size, size)
    body = data[np.repeat(start, size) + np.where(place >= wide, place - wide, place)]
    return binaries(body, size)


def multikey_order(keys: np.ndarray, ties: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``keys`` (8-byte characters, then ``ties``), and which equal the key before.

    Multikey quicksort: rows are parted by one character, and only rows still
    tied are parted by the next.
    """
    order = np.argsort(keys[:, 0], kind="stable")
    first = keys[order, 0]
    same = np.r_[False, first[1:] == first[:-1]] if len(order) else np.zeros(0, bool)
    for c in range(1, keys.shape[1] + 1):
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        if not len(tied):
            break
        group = np.cumsum(~same)[tied]
        if c == keys.shape[1]:
            order[tied] = order[tied][np.lexsort([t[order[tied]] for t in reversed(ties)] + [group])]
            break
        rows = order[tied]
        char = keys[rows, c]
        if np.array_equal(char[1:][group[1:] == group[:-1]], char[:-1][group[1:] == group[:-1]]):
            continue
        by = np.lexsort((char, group))
        order[tied], char = rows[by], char[by]
        same[tied[1:]] &= char[1:] == char[:-1]
    return order, same


def characters(bodies: pa.Array, more: list[np.ndarray]) -> np.ndarray:
    """Zero-padded big-endian 8-byte characters of each body, and ``more`` as the last ones."""
    data, ends = bytes_of(bodies)
    size = np.diff(ends)
    wide = -(-int(size.max()) // 8) * 8
    padded = np.zeros((len(size), wide), np.uint8)
    for lo in range(0, len(size), ROWS):    # places of so many values at a time
        part = size[lo:lo + ROWS]
        padded[np.repeat(np.arange(lo, lo + len(part)), part), flatten(np.zeros(len(part), np.int64), part)] = data[
            ends[lo]:ends[lo + len(part)]]
    return np.column_stack([padded.view(">u8").astype(U), *(m.astype(U) for m in more)])


ROW = "doc_id long, mark long, first int, n int, off int, body binary"
LEAST = pa.struct([("doc_id", pa.int64()), ("mark", pa.int64()), ("first", pa.int32())])
SORTED = (ROW + ", settled boolean, lo int, hi int, bucket int, head binary, tail binary, "
          "least struct<doc_id:long,mark:long,first:int>")
NAMES = [c.split()[0] for c in ROW.split(", ")]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and where each value starts and ends in them."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, ends


def binaries(data: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def whole(batches) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def longest_match(keys: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Of each of some sorted keys, at least the bytes (of its first ``own``) that it shares with any other.

    The longest match of a key is one with a neighbour.  The first and the last
    key have neighbours in other buckets: all their bytes may be shared.
    """
    if len(keys) < 2:
        return own
    raw = keys.astype(">u8").view(np.uint8).reshape(len(keys), -1)
    unlike = raw[1:] != raw[:-1]
    near = np.where(unlike.any(axis=1), unlike.argmax(axis=1), raw.shape[1])
    most = raw.shape[1]
    return np.minimum(own, np.maximum(np.r_[most, near], np.r_[near, most]))


def sort_suffixes(length: int):
    """The work of one bucket: sort its suffixes, settle what equals an earlier one.

    A group's first row stays open for the windows (``lo`` to ``hi``) that end
    within its longest match with another group.  Rows of the bucket's first
    group carry its number, as an earlier bucket may hold the group's first row;
    a row without doc_id sums the bucket up: the first and the last group's key
    and the last group's first row.
    """
    def run(batches):
        t = whole(batches)
        if t is None:
            return
        doc, mark, first, n, off = (t.column(c).to_numpy() for c in NAMES[:5])
        keys = characters(t.column("body").chunk(0), [n, off])
        order, same = multikey_order(keys, [doc, mark, first])
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))    # place of each group's first row
        at = order[lead]
        later = (doc[order] != doc[at]) | (mark[order] != mark[at]) | (first[order] != first[at])
        heads = order[~same]
        right = longest_match(keys[heads][:, :-2], n[heads].astype(np.int64) + length - 1 - off[heads])
        hi = np.zeros(len(order), np.int64)
        hi[~same] = np.clip(off[heads] + right - length + 1, 0, n[heads])
        out = np.flatnonzero(later | (hi > 0) | ((lead == 0) & ~same))
        rows = t.take(pa.array(order[out]))
        body = pa.array(np.where(later[out], None, rows.column("body").to_numpy()), pa.binary())
        bucket = TaskContext.get().partitionId()
        nothing = pa.nulls(len(out), pa.binary())
        names = [*NAMES, "settled", "lo", "hi", "bucket", "head", "tail", "least"]
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(c).combine_chunks() for c in NAMES[:5]), body, pa.array(later[out]),
             pa.array(np.zeros(len(out), np.int32)), pa.array(hi[out].astype(np.int32)),
             pa.array(np.full(len(out), bucket, np.int32), mask=lead[out] > 0), nothing, nothing,
             pa.nulls(len(out), LEAST)], names=names)
        last = heads[-1]
        sums = [keys[i].astype(">u8").tobytes() for i in (order[0], last)]
        least = {"doc_id": int(doc[last]), "mark": int(mark[last]), "first": int(first[last])}
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), *(pa.nulls(1, pa.int32()) for _ in range(3)),
             pa.nulls(1, pa.binary()), pa.array([False]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()),
             pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in sums), pa.array([least], LEAST)],
            names=names)
    return run


def sort_pass(rows: DataFrame, length: int, label: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (of :data:`ROW`) that are settled, or open with body, ``lo`` and ``hi``; and the written table."""
    dealt = rows.repartitionByRange("body", "off", "doc_id", "mark", "first")
    done = keep_only(dealt.mapInArrow(sort_suffixes(length), SORTED), label)
    ends = done.where("doc_id is null")
    # a key that closes one bucket and opens another: its first row is the least of those that close with it
    origin = ends.groupBy("tail").agg(F.min("least").alias("origin"))
    carried = ends.select("head", F.col("bucket").alias("b")).join(origin, F.col("head") == F.col("tail")).select(
        "b", "origin")
    own = F.struct("doc_id", "mark", "first")
    out = done.where("doc_id is not null").join(carried, F.col("bucket") == F.col("b"), "left")
    out = out.withColumn("settled", F.col("settled") | F.coalesce(own > F.col("origin"), F.lit(False)))
    return out.select(*NAMES, "settled", "lo", "hi"), done


def still_open(done: DataFrame) -> DataFrame:
    return done.where("not settled and body is not null and lo < hi").drop("settled")


def straight(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slices' bytes in text order, one after the other; where each starts; its size."""
    n, off = (batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in ("n", "off"))
    data, ends = bytes_of(batch.column(batch.schema.get_field_index("body")))
    size = n + length - 1
    place = flatten(np.zeros(len(size), np.int64), size) - np.repeat(off, size)
    return (data[np.repeat(ends[:-1], size) + np.where(place < 0, place + np.repeat(size, size), place)],
            np.cumsum(size) - size, size)


def prefix_rows(length: int, k: int):
    """Open slices with their prefix up to the gram's end, reversed, as key."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            data, base, _ = straight(b, length)
            size = b.column(4).to_numpy().astype(np.int64) + k
            place = np.repeat(base + size - 1, size) - flatten(np.zeros(len(size), np.int64), size)
            yield pa.RecordBatch.from_arrays([*b.columns, binaries(data[place], size)], names=[*b.schema.names, "key"])
    return run


def sort_prefixes(k: int):
    """One bucket of reversed prefixes: windows stay that begin within the longest match with a neighbour."""
    def run(batches):
        t = whole(batches)
        if t is None:
            return
        doc, mark, first, off, lo = (t.column(c).to_numpy() for c in ("doc_id", "mark", "first", "off", "lo"))
        keys = characters(t.column("key").chunk(0), [off])
        order, _ = multikey_order(keys, [doc, mark, first])
        left = np.empty(len(order), np.int64)
        left[order] = longest_match(keys[order][:, :-1], off[order].astype(np.int64) + k)
        at = t.schema.get_field_index("lo")
        t = t.set_column(at, "lo", pa.array(np.maximum(lo, off + k - left).astype(np.int32))).drop(["key"])
        yield from t.to_batches()
    return run


def prefix_pass(open_: DataFrame, length: int, k: int) -> DataFrame:
    """Open slices, cut on the left as well; slices that share no window with another are gone."""
    columns = ROW + ", lo int, hi int"
    keyed = open_.select(*NAMES, "lo", "hi").mapInArrow(prefix_rows(length, k), columns + ", key binary")
    return keyed.repartitionByRange("key", "doc_id", "mark", "first").mapInArrow(sort_prefixes(k), columns).where("lo < hi")


def cut_rows(length: int, single: bool):
    """What is open of each slice, as rows of :data:`ROW`; ``single``: each window as a suffix of its own."""
    def run(batch):
        if not batch.num_rows:
            return
        data, base, _ = straight(batch, length)
        names = batch.schema.names
        lo, hi, off = (batch.column(names.index(c)).to_numpy().astype(np.int64) for c in ("lo", "hi", "off"))
        many = hi - lo
        if single:
            of = np.repeat(np.arange(len(lo)), many)
            start = flatten(base + lo, many)
            count = np.ones(len(of), np.int64)
            anchor = start
        else:
            of, start, count, anchor = np.arange(len(lo)), base + lo, many, base + off
        rows = batch.select(["doc_id", "mark"]).take(pa.array(of))
        first = batch.column(2).to_numpy()[of] + start - base[of]
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, *(pa.array(x.astype(np.int32)) for x in (first, count, anchor - start)),
             turned(data, start, count, anchor, length)], names=NAMES)
    return arrow_map(run)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and a content mark that tells apart rows that repeat a doc_id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.xxhash64("text").alias("mark"))


def first_slices(docs: DataFrame, length: int, k: int) -> DataFrame:
    """``(doc_id, mark, first, n, gram)`` of every slice; windows of a short period come settled, without gram."""
    def cut(batch):
        for part in slices(batch, BATCH):
            texts = [np.frombuffer(x, np.uint8) for x in texts_of(part)]
            for row, lo, hi in chunks([len(x) for x in texts], length):
                data = np.concatenate([texts[i][s:e] for i, s, e in zip(row, lo, hi)])
                row, lo, size = np.array(row), np.array(lo), np.array(hi) - np.array(lo)
                base = np.cumsum(size) - size
                gone = periodic(data, base, length)
                at = flatten(base, size - length + 1)
                owner = np.repeat(np.arange(len(row)), size - length + 1)
                out = gone[at]
                turn = np.flatnonzero(np.r_[True, (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])])
                many = np.diff(np.r_[turn, len(at)])
                stay = ~out[turn]
                of, start, n, _, gram = cut_slices(data, at[turn[stay]], many[stay], length, k)
                piece = np.r_[owner[turn[stay]][of], owner[turn[~stay]]]
                start, n = np.r_[start, at[turn[~stay]]], np.r_[n, many[~stay]]
                ids = part.select(["doc_id", "mark"]).take(pa.array(row[piece]))
                known = np.arange(len(piece)) < len(gram)
                names = np.zeros(len(piece), np.int64)
                names[known] = gram.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*ids.columns, *(pa.array(x.astype(np.int32)) for x in (start - base[piece] + lo[piece], n)),
                     pa.array(names, mask=~known)], names=["doc_id", "mark", "first", "n", "gram"])

    return docs.mapInArrow(arrow_map(cut), "doc_id long, mark long, first int, n int, gram long")


def chunks(sizes: list[int], length: int):
    """Groups of text parts (indexes, starts, ends) of at most ``BATCH`` bytes or one part."""
    row, lo, hi, held = [], [], [], 0
    for i, size in enumerate(sizes):
        for s in range(0, size - length + 1, CUT):
            e = min(s + CUT + length - 1, size)
            if row and held + e - s > BATCH:
                yield row, lo, hi
                row, lo, hi, held = [], [], [], 0
            row.append(i), lo.append(s), hi.append(e)
            held += e - s
    if row:
        yield row, lo, hi


def fetch_slices(docs: DataFrame, asked: DataFrame, length: int, k: int) -> DataFrame:
    """The slices ``asked`` (doc_id, mark, list of (first, n)) with their bytes, as rows of :data:`ROW`."""
    asked = asked.select(rekeyed("doc_id").alias("d"), F.col("mark").alias("m"), "asked")
    src = docs.join(asked, (docs.doc_id == asked.d) & (docs.mark == asked.m)).select("doc_id", "mark", "text", "asked")

    def fetch(batch):
        for part in slices(batch, BATCH):
            text = part.column(2).cast(pa.binary())
            data, ends = bytes_of(text)
            ask = part.column(3)
            first, n = (ask.flatten().field(c).to_numpy().astype(np.int64) for c in range(2))
            row = np.repeat(np.arange(part.num_rows), ask.value_lengths().to_numpy())
            size = n + length - 1
            total = np.cumsum(size)
            lo = 0
            while lo < len(n):
                hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + BATCH)))
                near = slice(lo, hi)
                piece = data[flatten(ends[row[near]] + first[near], size[near])]
                base = np.cumsum(size[near]) - size[near]
                of, start, count, anchor, _ = cut_slices(piece, base, n[near], length, k)
                ids = part.select(["doc_id", "mark"]).take(pa.array(row[near][of]))
                yield pa.RecordBatch.from_arrays(
                    [*ids.columns, *(pa.array(x.astype(np.int32)) for x in (
                        first[near][of] + start - base[of], count, anchor - start)),
                     turned(piece, start, count, anchor, length)], names=NAMES)
                lo = hi

    return src.mapInArrow(arrow_map(fetch), ROW)


def whole_copies(docs: DataFrame, length: int) -> DataFrame:
    """``(doc_id, mark, n)``: texts of ``n`` windows that a smaller doc_id has too."""
    src = docs.select("doc_id", "mark", F.unhex(F.sha2("text", 256)).alias("digest"),
                      (F.octet_length("text") - (length - 1)).alias("n")).where("n > 0")
    first = src.groupBy("digest").agg(F.min("doc_id").alias("source"), F.count("*").alias("c")).where("c > 1").select(
        F.concat("digest", F.lit(b"")).alias("g"), "source")
    return src.join(first, src.digest == first.g).where("doc_id > source").select("doc_id", "mark", "n").distinct()


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, mark, gone)``: per text the runs ``(first, n)`` of window starts whose bytes also start earlier.

    ``docs`` as of :func:`identified`.  Runs jobs: each level's result is written,
    and removed once the answer is.
    """
    k = max(1, round(length * GRAM))
    src = docs.where("doc_id is not null")
    cut = keep_only(first_slices(src, length, k), "suffix-slices")
    several = cut.where("gram is not null").groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select(
        rekeyed("gram").alias("g"))
    pair = F.struct("first", "n")
    wanted = cut.join(several, cut.gram == several.g).groupBy("doc_id", "mark").agg(F.collect_set(pair).alias("asked"))
    copies = keep_only(whole_copies(src, length), "suffix-copies")
    asked = keep_only(wanted.join(copies.select("doc_id", "mark"), ["doc_id", "mark"], "left_anti"), "suffix-asked")
    local = keep_only(cut.where("gram is null").drop("gram"), "suffix-periods")
    release(cut)
    settled = lambda done: done.where("settled").select("doc_id", "mark", "first", "n")
    by_suffix, first = sort_pass(fetch_slices(src, asked, length, k), length, "suffix-sorted")
    release(asked)
    cleft = keep_only(prefix_pass(still_open(by_suffix), length, k), "suffix-cleft")
    by_rest, second = sort_pass(cleft.mapInArrow(cut_rows(length, False), ROW), length, "suffix-sorted-again")
    single, third = sort_pass(still_open(by_rest).mapInArrow(cut_rows(length, True), ROW), length, "suffix-sorted-windows")
    found = local.union(copies.select("doc_id", "mark", F.lit(0).alias("first"), "n"))
    for done in (by_suffix, by_rest, single):
        found = found.union(settled(done))
    cover = keep_only(found.groupBy("doc_id", "mark").agg(F.collect_set(pair).alias("gone")), "suffix-cover")
    release(copies, local, first, cleft, second, third)
    return cover


def drop_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` of every row of ``docs``.

    A byte of the UTF-8 text goes when a string of ``length`` bytes that covers
    it also starts earlier: in a smaller doc_id, or further left in the same
    document.  Strings are judged on the input and never cross documents.
    ``kept`` is binary, as a cut may part a character.  Null texts are empty.
    Rows without a doc_id stay whole and are no one's source.  Equal rows count
    as one document; rows that share a doc_id but not the text are taken in the
    order of a hash of their text.
    """
    src = identified(docs)
    cover = repeated_windows(src, length).select(rekeyed("doc_id").alias("d"), F.col("mark").alias("m"), "gone")
    joined = src.join(cover, (src.doc_id == cover.d) & (src.mark == cover.m), "left").select("doc_id", "text", "gone")

    def trim(batch):
        for part in slices(batch, 8 * BATCH):
            total, removed, spans, kept = [], [], [], []
            for text, gone in zip(texts_of(part), part.column(2)):
                total.append(len(text))
                if gone.is_valid:
                    edge = np.zeros(len(text) + 1, np.int64)
                    first, n = (gone.values.field(c).to_numpy() for c in range(2))
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + n + length - 1, -1)
                    out = np.cumsum(edge[:-1]) > 0
                    removed.append(int(out.sum()))
                    spans.append(int((out & ~np.r_[False, out[:-1]]).sum()))
                    text = np.frombuffer(text, np.uint8)[~out].tobytes()
                else:
                    removed.append(0), spans.append(0)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, pa.int64()) for x in (total, removed, spans)),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(arrow_map(trim), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
