"""Embedding near-duplicates from randomised-rotation binary codes.

RaBitQ (Gao and Long, 2024): a vector, rotated at random, is kept as its sign
bits and a correction factor, the inner product of the vector with its own
code.  The inner product of a code with another rotated vector, divided by that
factor, is an unbiased estimate of the vectors' cosine, with a confidence bound
that depends on the factor alone.  Pairs whose bound stays below the threshold
are settled by their codes; all others are computed again exactly, in double
precision, and only the exact value links them.

Pairs meet through bands of the sign bits: at the threshold, ``BANDS`` chosen
from the band width miss a pair with probability ``MISS`` at most, and more
similar pairs less often.  Equal vectors are first counted together.  A band
value with more than ``CELL`` vectors is split into chunks whose pairs are cells
of their own.  A pair that meets in several bands is counted in the first only;
cells return counts and a spanning forest, never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import arrow_map, keep, rekeyed
from eventide.llm.components import components
from eventide.llm.simhash import forest

MISS = 2e-4          # chance that a pair just at the threshold meets in no band
CELL = 512           # vectors of one band value that a chunk holds
PER_VALUE = 64       # unrelated vectors that share a band value, about
BOUND = 5.0          # standard deviations of the code's error that a rejection needs
TILE = 512           # rows compared at once
SEED = 42


def shape_of(n: int, threshold: float) -> tuple[int, int]:
    """(bits of a band, bands) for ``n`` vectors."""
    bits = min(24, max(6, round(math.log2(max(n, 1) / PER_VALUE))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - same))


class Rotation:
    """Random rotations of one dimension: one for the codes, as many rows as needed for the bands."""

    def __init__(self, dim: int, bits: int, bands: int):
        rng = np.random.default_rng((SEED, dim))
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        need, rows = bits * bands, []
        while sum(map(len, rows)) < need:
            rows.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
        self.planes = np.concatenate(rows)[:need]
        self.weights = 1 << np.arange(bits, dtype=np.int64)
        self.bits, self.bands = bits, bands

    def band_values(self, x: np.ndarray) -> np.ndarray:
        """Row by band: the sign bits of the band as a number."""
        return ((x @ self.planes.T) >= 0).reshape(len(x), self.bands, self.bits) @ self.weights

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rotated vectors, codes, correction factors)."""
        y = x @ self.turn.T
        code = np.where(y >= 0, 1.0, -1.0) / math.sqrt(x.shape[1])
        return y, code, np.abs(y).sum(axis=1) / math.sqrt(x.shape[1])


_made: dict[tuple, Rotation] = {}


def rotation(dim: int, bits: int, bands: int) -> Rotation:
    if (dim, bits, bands) not in _made:
        _made[dim, bits, bands] = Rotation(dim, bits, bands)
    return _made[dim, bits, bands]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow or underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links_between(rot: Rotation, a: np.ndarray, b: np.ndarray, band: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``a`` and ``b`` at or above ``threshold`` that meet in ``band`` and no earlier band."""
    ya, ca, fa = rot.codes(a)
    yb, cb, fb = rot.codes(b)
    da, db = rot.band_values(a), rot.band_values(b)
    dim = a.shape[1]
    margin = BOUND * np.sqrt((1 - fa ** 2).clip(0) / fa ** 2 / max(dim - 1, 1))
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(a), TILE):
        part = slice(lo, lo + TILE)
        guess = (ca[part] @ yb.T) / fa[part, None]
        i, j = np.nonzero(guess + margin[part, None] >= threshold)
        i += lo
        for s in range(0, len(i), 1 << 16):
            p, q = i[s:s + (1 << 16)], j[s:s + (1 << 16)]
            near = np.einsum("ij,ij->i", a[p], b[q]) >= threshold
            p, q = p[near], q[near]
            first = ~(da[p, :band] == db[q, :band]).any(axis=1)
            out_i.append(p[first])
            out_j.append(q[first])
    return np.concatenate(out_i), np.concatenate(out_j)


def vector_links(vectors: DataFrame, bits: int, bands: int, threshold: float, cell: int = CELL) -> DataFrame:
    """``(rep, other, links)`` rows of ``vectors(rep, times, vec)``: links counted by copies, and forest edges.

    Rows with ``other`` null carry counts, the others are edges.
    """
    def deal(batch):
        rep = batch.column(0).to_numpy()
        vecs = [np.asarray(v, np.float64) for v in batch.column(2).to_pylist()]
        for dim in {len(v) for v in vecs}:
            at = np.array([i for i, v in enumerate(vecs) if len(v) == dim])
            rot = rotation(dim, bits, bands)
            for lo in range(0, len(at), 256):
                own = at[lo:lo + 256]
                values = rot.band_values(unit(np.stack([vecs[i] for i in own])))
                rows = batch.take(pa.array(np.repeat(own, bands)))
                band = np.tile(np.arange(bands, dtype=np.int32), len(own))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), pa.array(band),
                     pa.array(values.ravel() + (dim << 32))], names=["rep", "times", "vec", "band", "value"])

    dealt = vectors.select("rep", "times", "vec").mapInArrow(
        arrow_map(deal), "rep long, times long, vec array<double>, band int, value long")
    places = vectors.select("rep", "times", "vec").mapInArrow(arrow_map(lambda b: (
        x.select(["band", "value"]) for x in deal(b))), "band int, value long")
    hot = places.groupBy("band", "value").count().where(F.col("count") > cell).select(
        rekeyed("band").alias("b"), rekeyed("value").alias("v"), F.ceil(F.col("count") / cell).alias("chunks"))
    full = dealt.join(hot, (dealt.band == hot.b) & (dealt.value == hot.v), "left")
    full = full.withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn(
        "chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    full = full.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
        F.xxhash64("band", "value", F.least("chunk", "j"), F.greatest("chunk", "j")).alias("cell"), "band",
        (F.col("chunk") <= F.col("j")).alias("low"), (F.col("chunk") == F.col("j")).alias("own"), "rep", "times", "vec")

    def settle(band, own, low, rep, times, vec):
        x = unit(np.stack(vec))
        rot = rotation(x.shape[1], bits, bands)
        if own.all():
            i, j = links_between(rot, x, x, band, threshold)
            i, j = i[i < j], j[i < j]
        else:
            lo, hi = np.flatnonzero(low), np.flatnonzero(~low)
            i, j = links_between(rot, x[lo], x[hi], band, threshold)
            i, j = lo[i], hi[j]
        count = np.bincount(i, times[j], len(rep)) + np.bincount(j, times[i], len(rep))
        hit = np.flatnonzero(count)
        lab = forest(len(rep), i, j)
        tied = np.flatnonzero(lab != np.arange(len(rep)))
        return (np.r_[rep[hit], rep[tied]], [None] * len(hit) + rep[lab[tied]].tolist(),
                np.r_[count[hit].astype(np.int64), np.zeros(len(tied), np.int64)])

    def run(batches):
        kept: list = []

        def flush(rows):
            cell, band, low, own, rep, times, vec = (np.array([r[k] for r in rows]) if k < 6 else
                                                     [np.asarray(r[k], np.float64) for r in rows] for k in range(7))
            out = settle(int(band[0]), own, low, rep, times, vec)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                               pa.array(out[2], pa.int64())], names=["rep", "other", "links"])
        for batch in batches:
            keys = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else []
            for lo, hi in zip(edges[:-1], edges[1:]):
                if kept and kept[0][0] != keys[lo]:
                    if len(kept) > 1:
                        yield flush(kept)
                    kept = []
                if not kept and hi < len(keys) and hi - lo == 1:
                    continue        # alone in its cell
                kept += zip(*(batch.column(k).slice(lo, hi - lo).to_pylist() for k in range(7)))
        if len(kept) > 1:
            yield flush(kept)

    cells = full.repartition("cell").sortWithinPartitions("cell")
    return cells.mapInArrow(run, "rep long, other long, links long")


def near_vectors(rows: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different length; equal vectors link
    with each other and alike with others.  A row with a null vec_id counts as a
    copy where an equal vector has an id (its component is that vector's); a
    vector that no id names links with nothing and has a null component;
    repeated rows count as vectors of their own.  An empty table gives no rows.
    """
    v = F.transform(F.col(vec), lambda x: x.cast("double") + F.lit(0.0))
    src = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vec"))
    bad = F.col("vec").isNull() | ~F.exists("vec", lambda x: x != 0) | F.exists(
        "vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    src = keep(src.withColumn("ok", ~F.coalesce(bad, F.lit(True))).withColumn(
        "mark", F.xxhash64("vec")), "vectors")
    good = src.where("ok").groupBy("mark", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times"))
    good = keep(good.where("rep is not null"), "vectors-distinct")
    bits, bands = shape_of(good.count(), threshold)
    found = keep(vector_links(good, bits, bands, threshold), "vectors-links")
    counts = found.where("other is null").groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null"), "rep", "other")
    named = (good.join(counts.select(rekeyed("rep").alias("r1"), "links"), F.col("rep") == F.col("r1"), "left")
             .join(joined.select(rekeyed("node").alias("r2"), "component"), F.col("rep") == F.col("r2"), "left")
             .select(F.col("mark").alias("m"), F.col("vec").alias("w"),
                     (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    out = src.join(named, src.ok & (src.mark == named.m) & (src.vec == named.w), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
