"""Source divergence audit over a K-squared quadtree of the group-term count matrix.

Per language, rows are the sources (groups) and columns the kept terms.  The
matrix is cut into blocks of ``GROUPS`` rows and about ``TERMS`` columns; each
pair of row blocks over one column block is one group of work, so neither a
language nor a source that holds most rows gathers in one task.  A block pair
builds a k2-tree (k = 2) per row block: each level names the quadrants that
hold a count.  The two trees are walked jointly for all pairs of groups: where
both quadrants are empty, all their columns cost each pair the same, so they
are only counted; leaves with a count on either side are priced one by one.
Blocks return a sum of prices and a number of empty columns per pair, which
Spark adds up.

Prices are whole numbers: ``p = 1 + floor(10**9 * (count + 2) / (N + 2 V))`` and
``f(p, q) = floor((p - q)**2 / (p + q))``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import arrow_map, keep_only, rekeyed, release, slices, texts_of

LEAST_DOCS = 10      # documents of the language that must hold a kept term
TOP = 10             # terms reported per group
SCALE = 10 ** 9
GROUPS = 32          # rows of a block
TERMS = 512          # columns of a block, about
BATCH = 1 << 22      # bytes of text counted together
# fixed values: what parts terms (all of ASCII but its letters), as bytes of UTF-8
GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
FOLD = bytes.maketrans(UPPER, LOWER)


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and rows that hold the term."""
    src = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
                      F.col("text").cast("string").alias("text"))

    def count(batch):
        for part in slices(batch, BATCH):
            keys = list(zip(*(part.column(c).to_pylist() for c in range(2))))
            total: dict[tuple, Counter] = {}
            held: dict[tuple, Counter] = {}
            for key, text in zip(keys, texts_of(part)):
                words = Counter(GAP.split(text.translate(FOLD)))
                words.pop(b"", None)
                total.setdefault(key, Counter()).update(words)
                held.setdefault(key, Counter()).update(words.keys())
            for key, words in total.items():
                n = len(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.string()),
                     pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(list(words.values()), pa.int64()),
                     pa.array([held[key][w] for w in words], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

    counted = src.mapInArrow(arrow_map(count), "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * kept))`` in exact arithmetic."""
    wide = lambda c: c.cast("decimal(20,0)")
    up = F.lit(SCALE).cast("decimal(10,0)") * wide(n + F.lit(2))
    return F.lit(1).cast("long") + F.call_function("div", up, wide(total + F.lit(2) * kept))


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)**2 / (p + q))``: at most 10**18, so exact in 64 bits."""
    return (p - q) * (p - q) // (p + q)


def price_column(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


class QuadTree:
    """k2-tree of a ``side`` x ``side`` matrix: per level the sorted names of the quadrants that hold a cell.

    A quadrant's name is its place in Morton order, so its four children are
    ``4 * name + 2 * lower + right`` and leaves are cells.
    """

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, height: int):
        code = np.zeros(len(row), np.int64)
        for b in range(height):
            code |= ((col >> b & 1) | (row >> b & 1) << 1) << 2 * b
        order = np.argsort(code)
        self.value = value[order]
        self.levels = [code[order]]
        for _ in range(height):
            up = self.levels[-1] >> 2
            self.levels.append(up[np.flatnonzero(np.r_[True, up[1:] != up[:-1]])] if len(up) else up)
        self.levels.reverse()

    def rank(self, level: int, name: np.ndarray) -> np.ndarray:
        """Place of each quadrant among its level's full ones, -1 where it is empty."""
        held = self.levels[level]
        if not len(held):
            return np.full(len(name), -1)
        at = np.minimum(np.searchsorted(held, name), len(held) - 1)
        return np.where(held[at] == name, at, -1)


def joint_prices(a: QuadTree, b: QuadTree, zero_a: np.ndarray, zero_b: np.ndarray, cols: int, height: int, same: bool):
    """Per pair of rows the price of the columns that either holds, and the number of columns that neither does.

    ``same``: both trees are one row block, and only rows ``i < j`` are paired.
    """
    side = 1 << height
    rows = len(zero_a), len(zero_b)
    empty = np.zeros(rows, np.int64)
    ra = rb = c = name_a = name_b = np.zeros(1, np.int64)
    for level in range(height + 1):
        here_a, here_b = a.rank(level, name_a), b.rank(level, name_b)
        width = side >> level
        void = (here_a < 0) & (here_b < 0)
        # empty on both sides: every pair of rows of the two quadrants has these columns for the same price
        counts = np.zeros([-(-n // width) for n in rows], np.int64)
        np.add.at(counts, (ra[void], rb[void]), np.clip(cols - c[void] * width, 0, width))
        empty += np.repeat(np.repeat(counts, width, 0)[:rows[0]], width, 1)[:, :rows[1]]
        go = ~void
        ra, rb, c, name_a, name_b, here_a, here_b = (x[go] for x in (ra, rb, c, name_a, name_b, here_a, here_b))
        if level == height:
            break
        half = width // 2
        parts = [(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)]
        ra, rb, c, name_a, name_b = (np.concatenate(x) for x in zip(*(
            (2 * ra + i, 2 * rb + j, 2 * c + k, 4 * name_a + 2 * i + k, 4 * name_b + 2 * j + k) for i, j, k in parts)))
        stay = (ra * half < rows[0]) & (rb * half < rows[1]) & (c * half < cols)
        if same:
            stay &= ra <= rb
        ra, rb, c, name_a, name_b = (x[stay] for x in (ra, rb, c, name_a, name_b))
    if same:
        stay = ra < rb
        ra, rb, here_a, here_b = ra[stay], rb[stay], here_a[stay], here_b[stay]
    p = np.where(here_a >= 0, a.value[here_a] if len(a.value) else 0, zero_a[ra])
    q = np.where(here_b >= 0, b.value[here_b] if len(b.value) else 0, zero_b[rb])
    full = np.zeros(rows, np.int64)
    np.add.at(full, (ra, rb), price(p, q))
    return full, empty


BLOCK = ("lang string, a_block int, b_block int, left int, right int, full long, empty long")


def price_block(frame: pd.DataFrame) -> pd.DataFrame:
    """All pairs of groups of two row blocks over one block of columns."""
    at = frame.iloc[0]
    cols, one = int(at["cols"]), int(at["a_block"]) == int(at["b_block"])
    cells = frame[frame["term"].notna()]
    heads = frame[frame["term"].isna()]
    terms = {t: i for i, t in enumerate(cells["term"].value_counts().index)}    # frequent terms lie together
    zeros = []
    for side in (0, 1):
        h = heads[heads["side"] == side].sort_values("row")
        zeros.append(h["p"].to_numpy(np.int64))
    if one:
        zeros[1] = zeros[0]
    height = max(int(max(cols, *(len(z) for z in zeros), 1) - 1).bit_length(), 0)
    trees = []
    for side in (0, 1):
        c = cells[cells["side"] == side]
        trees.append(QuadTree(c["row"].to_numpy(np.int64), c["term"].map(terms).to_numpy(np.int64),
                              c["p"].to_numpy(np.int64), height))
    if one:
        trees[1] = trees[0]
    full, empty = joint_prices(*trees, *zeros, cols, height, one)
    i, j = np.nonzero(np.ones(full.shape, bool) if not one else np.triu(np.ones(full.shape, bool), 1))
    return pd.DataFrame({"lang": at["lang"], "a_block": np.int32(at["a_block"]), "b_block": np.int32(at["b_block"]),
                         "left": i.astype(np.int32), "right": j.astype(np.int32), "full": full[i, j],
                         "empty": empty[i, j]})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair``: how far each other source of the language lies from the
    group, over all kept terms.  Part ``term``: the ``top`` terms that the group
    uses more than its language.  Null text, lang and source count as ''; rows
    that repeat a document count as documents; an empty table gives no rows; a
    language without kept terms has pairs of value 0.  Runs jobs: the counts
    and the matrix are written.
    """
    counts = keep_only(term_counts(docs), "term-counts")
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    # a term's block: the terms of a language are dealt to as many blocks as they fill
    known = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).where(
        F.col("d") >= least_docs).drop("d")
    known = keep_only(known, "kept-terms")
    vocab = known.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    terms = known.select(F.col("lang").alias("l"), F.col("term").alias("t"), "lang_n")
    cells = keep_only(counts.join(terms, (counts.lang == terms.l) & (counts.term == terms.t)).select(
        "lang", "source", "term", "n", "lang_n"), "kept-counts")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    spot = Window.partitionBy("lang").orderBy("source")     # one row per group of a language
    groups = groups.join(totals, ["lang", "source"], "left").join(vocab, "lang", "left").fillna(
        0, ["total", "kept", "lang_total"])
    groups = groups.withColumn("at", F.row_number().over(spot) - 1).withColumn(
        "many", F.count("*").over(Window.partitionBy("lang")))
    groups = keep_only(groups.withColumn("p0", F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col(
        "kept"))).otherwise(F.lit(1))).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS))), "groups")
    release(counts)
    placed = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "at", "many", "total", "kept",
                           "lang_total", "blocks")
    cells = cells.join(placed, (cells.lang == placed.l) & (cells.source == placed.s)).drop("l", "s")
    cells = cells.withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")

    def sides(df: DataFrame) -> DataFrame:
        """Each row once per pair of row blocks that its block takes part in, as left (0) or right (1) side."""
        mine = F.floor(F.col("at") / GROUPS).cast("int")
        last = F.floor((F.col("many") - 1) / GROUPS).cast("int")
        left = F.transform(F.sequence(mine, last), lambda o: F.struct(mine.alias("a_block"), o.alias("b_block"),
                                                                      F.lit(0).alias("side")))
        right = F.when(mine > 0, F.transform(F.sequence(F.lit(0), mine - 1), lambda o: F.struct(
            o.alias("a_block"), mine.alias("b_block"), F.lit(1).alias("side"))))
        return df.withColumn("_x", F.explode(F.concat(left, F.coalesce(right, F.array())))).select(
            "lang", "_x.*", "block", (F.col("at") % GROUPS).alias("row"), "term", "p", "cols")

    widths = known.join(vocab.select(F.col("lang").alias("l"), "kept"), F.col("lang") == F.col("l")).withColumn(
        "blocks", F.ceil(F.col("kept") / TERMS)).groupBy("lang", block.alias("block")).agg(F.count("*").alias("cols"))
    heads = groups.withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    heads = heads.join(widths.withColumnRenamed("block", "b").withColumnRenamed("lang", "l"),
                       (F.col("lang") == F.col("l")) & (F.col("block") == F.col("b")), "left").drop("l", "b").fillna(0, ["cols"])
    heads = heads.select("lang", "at", "many", "block", F.lit(None).cast("string").alias("term"),
                         F.col("p0").alias("p"), "cols")
    cell_rows = cells.withColumn("block", block)
    cell_rows = cell_rows.select("lang", "at", "many", "block", "term", "p", F.lit(0).cast("long").alias("cols"))
    matrix = sides(heads.union(cell_rows))
    # heads first, so that the first row of a group of work names its width
    priced = matrix.groupBy("lang", "a_block", "b_block", "block").applyInPandas(
        lambda frame: price_block(frame.sort_values("cols", ascending=False)), BLOCK)
    pairs = priced.groupBy("lang", "a_block", "b_block", "left", "right").agg(
        F.sum("full").alias("full"), F.sum("empty").alias("empty")).select(
        "lang", (F.col("a_block") * GROUPS + F.col("left")).alias("i"),
        (F.col("b_block") * GROUPS + F.col("right")).alias("j"), "full", "empty")
    name = lambda c: groups.select(F.col("lang").alias(f"{c}_l"), F.col("at").alias(f"{c}_at"),
                                   F.col("source").alias(f"{c}_source"), F.col("p0").alias(f"{c}_p"))
    pairs = pairs.join(name("a"), (F.col("lang") == F.col("a_l")) & (F.col("i") == F.col("a_at"))).join(
        name("b"), (F.col("lang") == F.col("b_l")) & (F.col("j") == F.col("b_at")))
    value = F.col("full") + F.col("empty") * price_column(F.col("a_p"), F.col("b_p"))
    both = F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
                   F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")))
    pairs = pairs.select("lang", F.explode(both).alias("_x"), value.alias("value")).select(
        "lang", "_x.source", F.lit("pair").alias("part"), "_x.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    used = cells.withColumn("q", q).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        price_column(F.col("p"), F.col("q")).alias("value"))
    used = used.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.union(used)
