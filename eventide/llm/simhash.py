"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints (64 bits, word shingles) within ``max_bits`` of each other agree
on at least one of ``max_bits + 1`` equal blocks of bits.  For each block, a
copy of the fingerprint is led by it, and all copies are sorted by Gray rank
over the tasks.  Each task factors its sorted copies, batch by batch, into nodes
that hold the bits all members share, up to one root, and descends pairs of
nodes: a pair is opened only while its shared lead bits are equal and its other
shared bits differ in at most ``max_bits`` places.  Every link comes out of this
descent.  A lead with more than ``CELL`` fingerprints is led further by the
blocks of its other bits, of which linked fingerprints also share at least one;
only a lead that is still too large there is split into chunks, each pair of
them a lead of its own, so no task holds a hot group.  Batches return a spanning
forest of the links they find, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import arrow_map, keep, rekeyed, slices, texts_of
from eventide.llm.components import components

SEED = 42
CELL = 512          # fingerprints of one dealt value before it is dealt or split further
FANOUT = 8          # children per index node
BLOCK_BITS = 16     # bits of a block used for dealing: at most (max_bits + 1) * 2**16 values
HASHES = 1 << 18    # shingle hashes held at once
BATCH = 1 << 21     # bytes of text held at once


def fingerprint(words: list[bytes], k: int) -> int:
    """Majority bits of the shingles' XXH64; fewer than ``k`` words are one shingle, none give 0."""
    n = max(len(words) - k + 1, 1) if words else 0
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, HASHES):
        part = words[lo:min(lo + HASHES, n) + k - 1]
        m = max(len(part) - k + 1, 1)
        grams = map(b" ".join, zip(*(part[i:] for i in range(k)))) if len(part) >= k else [b" ".join(part)]
        h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, m)
        for s in range(0, m, 1 << 14):
            bits = np.unpackbits(h[s:s + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(ones * 2 > n)))


def fingerprints(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, mark, fp)``: signed 64-bit fingerprint and content mark of every whole text (null: empty)."""
    def run(batch):
        for part in slices(batch, BATCH):
            fps = [fingerprint(t.lower().split(), k) for t in texts_of(part)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=["doc_id", "mark", "fp"])
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                      F.xxhash64(text).alias("mark"))
    return src.mapInArrow(arrow_map(run), "doc_id long, mark long, fp long")


# ---- the index of a batch ---------------------------------------------------

def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each code word in the reflected Gray order."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _levels(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, pattern) of the shared bits, leaf level first; ``fp`` is in Gray order."""
    ands, ors = fp, fp
    out = [(np.full(len(fp), ~np.uint64(0)), fp)]
    while len(ands) > 1:
        at = np.arange(0, len(ands), FANOUT)
        ands, ors = np.bitwise_and.reduceat(ands, at), np.bitwise_or.reduceat(ors, at)
        out.append((~(ands ^ ors), ands))
    return out


def node_pairs(fp: np.ndarray, max_bits: int, lead: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes still open on each level below the root, leaves last.

    A pair stays open while the bits that both nodes share differ nowhere in
    ``lead`` and in at most ``max_bits`` places in ``fp``.
    """
    a = b = np.zeros(1, np.int64)
    kids = np.arange(FANOUT)
    for (mask, pattern), (lead_mask, lead_pattern) in zip(_levels(fp)[-2::-1], _levels(lead)[-2::-1]):
        n = len(pattern)
        ca = np.repeat(a[:, None] * FANOUT + kids, FANOUT, axis=1).ravel()
        cb = np.tile(b[:, None] * FANOUT + kids, (1, FANOUT)).ravel()
        ok = (ca < n) & (cb < n) & (ca <= cb)
        a, b = ca[ok], cb[ok]
        same = (lead_pattern[a] ^ lead_pattern[b]) & lead_mask[a] & lead_mask[b] == 0
        a, b = a[same], b[same]
        diff = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b])
        a, b = a[diff <= max_bits], b[diff <= max_bits]
        yield a, b


def tree_links(fp: np.ndarray, max_bits: int, lead: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of equal ``lead`` within ``max_bits`` of each other; (``lead``, ``fp``) is in Gray order."""
    a = b = np.zeros(0, np.int64)
    for a, b in node_pairs(fp, max_bits, np.zeros_like(fp) if lead is None else lead):
        pass
    return a[a < b], b[a < b]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` items over the links ``a``-``b``."""
    lab = np.arange(n)
    while len(a):
        m = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, lab[a], m)
        np.minimum.at(new, lab[b], m)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, lab):
            break
        lab = new
    return lab


def gray_order(lead: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Row order by the Gray rank of the 128-bit code ``lead``, ``fp``."""
    low = gray_rank(fp)
    return np.lexsort((np.where(np.bitwise_count(lead) & 1, ~low, low), gray_rank(lead)))


def rank_of(code: Column, bits: int) -> Column:
    """:func:`gray_rank` of a code of ``bits`` bits, as a column."""
    def folded(s: int):
        return lambda v: v.bitwiseXOR(F.shiftrightunsigned(v, s))
    s = 1
    while s < bits:
        code = F.transform(F.array(code), folded(s))[0]
        s *= 2
    return code


def gray_links(reps: DataFrame, max_bits: int, cell: int = CELL) -> DataFrame:
    """``(a, b)``: a spanning forest, per cell, of ``reps(fp, rep)`` linked within ``max_bits``."""
    blocks = max_bits + 1
    width = 64 // blocks
    low = (1 << min(width, BLOCK_BITS)) - 1
    inner = (64 - width) // blocks
    turned = F.array(*[F.struct(
        F.lit(r).alias("r"), F.shiftrightunsigned("fp", r * width).bitwiseOR(
            F.shiftleft("fp", (64 - r * width) % 64)).alias("turn")) for r in range(blocks)])
    rot = reps.select("fp", "rep", F.explode(turned).alias("b")).select("fp", "rep", "b.r", "b.turn")
    rot = rot.withColumn("key", F.col("turn").bitwiseAND(F.lit(low)))
    # at most blocks * 2**BLOCK_BITS rows, whatever the input: small enough to broadcast
    hot = rot.groupBy("r", "key").count().where(F.col("count") > cell)
    rot = rot.join(F.broadcast(hot), ["r", "key"], "left")
    lead = F.shiftleft(F.col("r").cast("long"), BLOCK_BITS).bitwiseOR(F.col("key"))
    cool = rot.where("count is null").select(
        rank_of(lead, BLOCK_BITS + blocks.bit_length()).alias("rank"), "fp", "rep")
    again = F.array(*[F.struct(
        F.lit(s).alias("s"), F.shiftrightunsigned("turn", width + s * inner).bitwiseAND(
            F.lit((1 << inner) - 1)).alias("sub")) for s in range(blocks)])
    parts = rot.where("count is not null").withColumn("b", F.explode(again)).select(
        F.xxhash64("r", "key", "b.s", "b.sub").alias("value"), "fp", "rep")
    still = parts.groupBy("value").count().where(F.col("count") > cell).select(
        rekeyed("value").alias("v"), F.ceil(F.col("count") / cell).alias("chunks"))
    split = parts.join(still, parts.value == still.v, "left").select(
        "value", "fp", "rep", F.coalesce("chunks", F.lit(1).cast("long")).alias("chunks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    split = (split.withColumn("c", mine).withColumn("cell", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda j: F.least("c", j) * F.col("chunks") + F.greatest("c", j))))
        .select(F.xxhash64("value", "cell").alias("rank"), "fp", "rep"))
    dealt = cool.union(split)

    def links(ranks, fps, reps_):
        ranks = ranks.view(np.uint64)
        lead = ranks ^ (ranks >> np.uint64(1))
        order = gray_order(lead, fps)
        lead, fps, reps_ = lead[order], fps[order], reps_[order]
        a, b = tree_links(fps, max_bits, lead)
        lab = forest(len(fps), a, b)
        i = np.flatnonzero(lab != np.arange(len(lab)))
        return pa.RecordBatch.from_arrays([pa.array(reps_[i]), pa.array(reps_[lab[i]])], names=["a", "b"])

    def run(batches):
        kept = None  # the last lead of a batch may go on in the next
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols = [cols[0], cols[1].view(np.uint64), cols[2]]
            if kept:
                cols = [np.concatenate(x) for x in zip(kept, cols)]
            if not len(cols[0]):
                continue
            end = np.searchsorted(cols[0], cols[0][-1])
            yield links(*(c[:end] for c in cols))
            kept = [c[end:] for c in cols]
        if kept:
            yield links(*kept)

    index = dealt.repartitionByRange("rank").sortWithinPartitions("rank")
    return index.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 3, max_bits: int = 3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(doc_id, mark, fp, component_id)`` of every row of ``docs``.

    Texts: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, ``k``-word shingles with
    repeats.  Fingerprints at ``max_bits`` or fewer differing bits link; the
    component is the smallest doc_id reachable.  Null or empty texts have
    fingerprint 0 and link like any other; a null doc_id gets its group's
    component (null if no row of the group has an id); repeated rows give
    repeated rows; an empty table gives none.
    """
    fps = keep(fingerprints(docs, k, doc_id, text), "simhash")
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    reps = keep(reps, "simhash-reps")
    found = components(gray_links(reps.where("rep is not null"), max_bits), "a", "b")
    named = reps.join(found, reps.rep == found.node, "left").select(
        rekeyed("fp").alias("key"), F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, fps.fp == named.key).select(
        "doc_id", "mark", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` (all columns) whose doc_id is its component's smallest.

    Rows without a doc_id stay.  Rows that repeat a doc_id are judged each by its
    own text; repeats of a row that stays all stay.
    """
    near = near_duplicates(docs, k, max_bits)
    gone = near.where("doc_id <> component_id").select(
        F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_mark"]),
                     "left_anti")
