"""Skew-safe ordered scans per key: neighbour rows, running sums / maxima / minima.

Every sequence operator of the library (failure pairs and bursts, order
funnels, reconciliation chains, click caps, late-data watermarks) needs, per
key and in event order, either a neighbour row or a running aggregate.  A plain
``Window.partitionBy(key).orderBy(ts)`` puts all rows of a key into one task,
so a hot key (one user holding a third of the stream) becomes one task.

``keyed_scan`` splits every key further by a *bucket* column that is monotone
in the order (a time bucket, or an arrival-sequence chunk):

1. The input is hash-partitioned once by ``(key, bucket)``.  Groups are
   small and spread over all tasks, whatever the key skew.
2. A per-``(key, bucket)`` summary (first row, last row, bucket totals) is
   aggregated from the same rows (AQE reuses the exchange where its columns
   allow; where it does not, the input is read and dealt a second time).
3. A window over the summary, ordered by bucket, carries the neighbour row
   and the running totals across buckets.  It holds one row per non-empty
   bucket, so its size per key is bounded by time span / bucket width, not
   by the number of events.
4. The carry enters each ``(key, bucket)`` group as a *head* row (previous
   bucket's last row, totals of earlier buckets) and a *tail* row (next
   bucket's first row, totals of later buckets).  One window per group then
   yields exact ``lag``/``lead``/running values; head and tail rows are
   dropped.  No join is needed, and null keys form their own group.

The result is exact: neighbours are the true previous/next rows of the key,
running values are over the whole key history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BK = "_scan_bucket"
FAN = 4096                 # buckets summarised together where there is no key
_RT = "_scan_rowtype"      # 0 head (carry in), 1 data, 2 tail (carry from later buckets)


@dataclass(frozen=True)
class Running:
    """A running aggregate added as column ``name``.

    ``agg``: ``sum`` | ``max`` | ``min``.  ``direction``: ``prefix`` (rows
    before, in order) or ``suffix`` (rows after).  ``inclusive``: whether the
    current row counts.
    """

    name: str
    expr: Column
    agg: str = "sum"
    direction: str = "prefix"
    inclusive: bool = True


def _agg(kind: str, c: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](c)


def _fields(order: list[str], cols: list[str]) -> list[str]:
    return order + [c for c in cols if c not in order]


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], bucket: Column, *,
               prev: list[str] = (), next: list[str] = (),  # noqa: A002
               running: list[Running] = (), prefix_prev: str = "prev_",
               prefix_next: str = "next_", _top: bool = False) -> DataFrame:
    """Add neighbour and running columns per key, in ``order``.

    ``order`` columns must be non-null and unique per key (add a sequence
    column as tie-break).  ``bucket`` must be non-decreasing along ``order``
    within a key, e.g. ``floor(ts / 1 hour)``.

    Adds ``prev_<c>`` / ``next_<c>`` for ``c`` in ``prev`` / ``next`` (null at
    the ends), and one column per ``Running`` spec (null when its frame is
    empty).
    """
    keys, order = list(keys), list(order)
    prev, next_, running = list(prev), list(next), list(running)
    part = keys + [_BK]
    rcols = [f"_scan_r{i}" for i in range(len(running))]
    d = df.withColumn(_BK, bucket)
    for rc, r in zip(rcols, running):
        d = d.withColumn(rc, r.expr)
    d = d.repartition(*part)

    # ---- summary per (key, bucket), from the same exchange -----------------
    aggs = []
    if prev:
        aggs.append(F.max(F.struct(*[F.col(c) for c in _fields(order, prev)])).alias("_last"))
    if next_:
        aggs.append(F.min(F.struct(*[F.col(c) for c in _fields(order, next_)])).alias("_first"))
    for rc, r in zip(rcols, running):
        aggs.append(_agg(r.agg, F.col(rc)).alias(rc))
    summary = d.groupBy(*part).agg(*aggs)

    # ---- carry across buckets (one row per non-empty bucket) -------------
    if keys or _top:
        # suffix frames are prefix frames of the reversed order: Spark re-aggregates
        # the whole rest of the partition per row for ``unboundedFollowing``
        w_k = Window.partitionBy(*keys).orderBy(_BK) if keys else Window.orderBy(_BK)
        w_r = Window.partitionBy(*keys).orderBy(F.desc(_BK)) if keys else Window.orderBy(F.desc(_BK))
        carry_cols = [F.col(k) for k in part]
        if prev:
            carry_cols.append(F.lag("_last").over(w_k).alias("_cp"))
        if next_:
            carry_cols.append(F.lead("_first").over(w_k).alias("_cn"))
        for rc, r in zip(rcols, running):
            w_c = (w_k if r.direction == "prefix" else w_r).rowsBetween(Window.unboundedPreceding, -1)
            carry_cols.append(_agg(r.agg, F.col(rc)).over(w_c).alias(rc))
        carry = summary.select(*carry_cols)
    else:
        # without a key the summary itself is scanned, in groups of FAN buckets: only
        # the second level's rows (one per FAN buckets) meet in one window
        level = summary.withColumnRenamed(_BK, "_b").withColumnsRenamed(
            {rc: "_t" + rc for rc in rcols})
        level = keyed_scan(
            level, [], ["_b"], F.floor(F.col("_b") / FAN), prev=["_last"] if prev else [],
            next=["_first"] if next_ else [],
            running=[Running(rc + "c", F.col("_t" + rc), r.agg, r.direction, False)
                     for rc, r in zip(rcols, running)], _top=True)
        carry = level.select(
            F.col("_b").alias(_BK), *([F.col("prev__last").alias("_cp")] if prev else []),
            *([F.col("next__first").alias("_cn")] if next_ else []),
            *[F.col(rc + "c").alias(rc) for rc in rcols])

    schema = {f.name: f.dataType for f in d.schema.fields}
    data_cols = [c for c in d.columns]

    def carry_rows(rowtype: int, struct_col: str | None, fields: list[str], direction: str):
        cols = []
        for c in data_cols:
            if c in part:
                cols.append(F.col(c))
            elif c in rcols:
                r = running[rcols.index(c)]
                cols.append(F.col(c) if r.direction == direction
                            else F.lit(None).cast(schema[c]).alias(c))
            elif struct_col is not None and c in fields:
                cols.append(F.col(f"{struct_col}.{c}").cast(schema[c]).alias(c))
            else:
                cols.append(F.lit(None).cast(schema[c]).alias(c))
        # same hash partitioning as the data side, so the union stays clustered
        return carry.select(*cols, F.lit(rowtype).alias(_RT)).repartition(*part)

    pieces = [d.withColumn(_RT, F.lit(1))]
    if prev or any(r.direction == "prefix" for r in running):
        pieces.append(carry_rows(0, "_cp" if prev else None, _fields(order, prev), "prefix"))
    if next_ or any(r.direction == "suffix" for r in running):
        pieces.append(carry_rows(2, "_cn" if next_ else None, _fields(order, next_), "suffix"))
    u = pieces[0]
    for p in pieces[1:]:
        u = u.unionByName(p)

    # ---- one window per (key, bucket) over head + data + tail -------------
    w = Window.partitionBy(*part).orderBy(F.col(_RT), *[F.col(c) for c in order])
    back = Window.partitionBy(*part).orderBy(F.desc(_RT), *[F.desc(c) for c in order])
    frames = {("prefix", True): w.rowsBetween(Window.unboundedPreceding, Window.currentRow),
              ("prefix", False): w.rowsBetween(Window.unboundedPreceding, -1),
              ("suffix", True): back.rowsBetween(Window.unboundedPreceding, Window.currentRow),
              ("suffix", False): back.rowsBetween(Window.unboundedPreceding, -1)}
    out_cols = [F.col(c) for c in df.columns]
    out_cols += [F.lag(c).over(w).alias(prefix_prev + c) for c in prev]
    out_cols += [F.lead(c).over(w).alias(prefix_next + c) for c in next_]
    for rc, r in zip(rcols, running):
        out_cols.append(_agg(r.agg, F.col(rc)).over(frames[(r.direction, r.inclusive)]).alias(r.name))
    return u.select(*out_cols, F.col(_RT)).filter(F.col(_RT) == 1).drop(_RT)


def time_bucket(ts_us: Column, width_us: int) -> Column:
    """Bucket id of epoch microseconds for ``keyed_scan`` (monotone in time)."""
    return ((ts_us - F.pmod(ts_us, F.lit(width_us))) / F.lit(width_us)).cast("bigint")


def bounded_prev(df: DataFrame, keys: list[str], order: list[str], ts_us: Column, within_us: int,
                 cols: list[str], width_us: int | None = None,
                 prefix_prev: str = "prev_") -> DataFrame:
    """``prev_<c>`` for predicates that only look back at most ``within_us``.

    When a caller only uses the previous row if it lies within ``within_us``
    (failure pairs, strict two-step patterns), the full cross-bucket carry is
    not needed: each row is also copied into the buckets whose first
    ``within_us`` it covers (a *halo*), and one window per ``(key, bucket)``
    finds the previous row.  Exact for such predicates: any row within
    ``within_us`` before a row of bucket ``b`` is present in ``b``; an earlier
    previous row is farther than the bound, so whatever ``lag`` returns then
    fails the predicate too (``prev_gap_us`` is returned for that test).
    One shuffle; rows are duplicated by about ``within_us / width_us``.
    """
    width = max(width_us or 0, within_us, 1)
    t = ts_us
    b0 = (t - F.pmod(t, F.lit(width))) / F.lit(width)
    b1 = ((t + F.lit(within_us)) - F.pmod(t + F.lit(within_us), F.lit(width))) / F.lit(width)
    d = df.withColumn("_bp_us", t).withColumn("_bp_home", b0.cast("bigint")) \
        .withColumn(_BK, F.explode(F.sequence(b0.cast("bigint"), b1.cast("bigint"))))
    w = Window.partitionBy(*keys, _BK).orderBy(*[F.col(c) for c in order])
    out = d.select("*", *[F.lag(c).over(w).alias(prefix_prev + c) for c in cols],
                   (F.col("_bp_us") - F.lag("_bp_us").over(w)).alias("prev_gap_us"))
    return out.filter(F.col(_BK) == F.col("_bp_home")).drop(_BK, "_bp_home", "_bp_us")


def bounded_next_min(df: DataFrame, keys: list[str], order: list[str], ts_us: Column,
                     within_us: int, name: str, expr: Column,
                     width_us: int | None = None) -> DataFrame:
    """Minimum of ``expr`` over the rows after each row, exact within ``within_us``.

    The forward twin of ``bounded_prev``: each row is also copied into the
    buckets whose last ``within_us`` it covers, so every row less than
    ``within_us`` after a row of bucket ``b`` is present in ``b``.  The result
    ``name`` is exact whenever the true minimum's row lies within the bound
    (callers test that bound themselves, as the order funnel does).
    """
    width = max(width_us or 0, within_us, 1)
    t = ts_us
    b1 = (t - F.pmod(t, F.lit(width))) / F.lit(width)
    b0 = ((t - F.lit(within_us)) - F.pmod(t - F.lit(within_us), F.lit(width))) / F.lit(width)
    d = df.withColumn("_bn_home", b1.cast("bigint")).withColumn("_bn_expr", expr) \
        .withColumn(_BK, F.explode(F.sequence(b0.cast("bigint"), b1.cast("bigint"))))
    w = Window.partitionBy(*keys, _BK).orderBy(*[F.desc(c) for c in order]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    out = d.select("*", F.min("_bn_expr").over(w).alias(name))
    return out.filter(F.col(_BK) == F.col("_bn_home")).drop(_BK, "_bn_home", "_bn_expr")
