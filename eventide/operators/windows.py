"""Event-time window counts (O-24..O-28).

Windows are epoch-aligned, ``[start, end)``, on UTC instants; a window with no
event is not emitted.  Durations are given as ``datetime.timedelta`` or as
whole microseconds.

Sliding counts with few windows per row use Spark's ``window()`` (expand +
map-side partial aggregate).  With many windows per row (10 min every 5 s: 120;
1 day every 5 s: 17,280) rows are counted per slide-wide *pane*, each pane adds
signed deltas at its first window end and after its last, and a running sum
per key gives intervals of window ends with constant count
(``sliding_count_sparse``), expanded only when every window is needed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.text import salt as _salt
from eventide.functions.time import from_micros, micros
from eventide.operators.scan import Running, keyed_scan, time_bucket


def us(d) -> int:
    """Microseconds of a ``timedelta`` (or an int already in microseconds)."""
    if isinstance(d, _dt.timedelta):
        return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds
    return int(d)


def pane_end_us(ts: str | Column, slide_us: int) -> Column:
    """End (exclusive) of the slide-wide pane holding ``ts``, in epoch microseconds."""
    t = micros(ts)
    return t - F.pmod(t, F.lit(slide_us)) + F.lit(slide_us)


def tumbling_count(df: DataFrame, keys: list[str], size, ts: str = "ts",
                   count_name: str = "cnt") -> DataFrame:
    """O-25: rows per key and tumbling window -> keys, window_start, window_end, cnt."""
    size_us = us(size)
    e = pane_end_us(ts, size_us)
    agg = df.where(F.col(ts).isNotNull()).groupBy(*keys, e.alias("_e")).agg(
        F.count(F.lit(1)).alias(count_name))
    return agg.select(*keys, from_micros(F.col("_e") - F.lit(size_us)).alias("window_start"),
                      from_micros("_e").alias("window_end"), count_name)


# Measured crossover (5M rows: 12 windows per row window() 5.7 s vs intervals 17.2 s;
# 1M rows: 120 windows per row window() 78 s vs intervals 20 s).
EXPAND_MAX_WINDOWS = 32


def sliding_count(df: DataFrame, keys: list[str], size, slide, ts: str = "ts",
                  count_name: str = "cnt") -> DataFrame:
    """O-26: rows per key and sliding window -> keys, window_start, window_end, cnt.

    Up to ``EXPAND_MAX_WINDOWS`` windows per row, Spark's ``window()`` is the
    best plan: each row is expanded inside the scan stage and combined by the
    partial aggregate before the shuffle.  Beyond that the expansion dominates,
    and the count is computed as constant-count intervals of window ends from
    signed deltas (``sliding_count_sparse``), expanded only at the end.
    """
    size_us, slide_us = us(size), us(slide)
    if size_us > EXPAND_MAX_WINDOWS * slide_us:
        return sliding_count_dense(df, keys, size, slide, ts).withColumnRenamed("cnt", count_name)
    w = F.window(ts, f"{size_us} microseconds", f"{slide_us} microseconds")
    agg = df.groupBy(*keys, w.alias("_w")).agg(F.count(F.lit(1)).alias(count_name))
    return agg.select(*keys, F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"), count_name)


def pv_per_window(df: DataFrame, size, ts: str = "ts") -> DataFrame:
    """O-25 global: page views per tumbling window -> window_end, cnt."""
    return tumbling_count(df, [], size, ts).select("window_end", "cnt")


def pv_salted(df: DataFrame, size, n: int = 10, ts: str = "ts",
              salt_cols: list[str] | None = None) -> DataFrame:
    """O-24: two-phase count: per (salt, window), then summed per window.

    The salt is a hash of the row (deterministic, so a retried task sees the
    same salt).  For ``count`` Catalyst's partial aggregation already avoids a
    hot window; the explicit salt matters for aggregates without a partial form.
    """
    size_us = us(size)
    cols = salt_cols or [c for c in df.columns]
    e = pane_end_us(ts, size_us)
    first = df.where(F.col(ts).isNotNull()).groupBy(_salt(cols, n).alias("_s"), e.alias("_e")).agg(F.count(F.lit(1)).alias("_c"))
    return first.groupBy("_e").agg(F.sum("_c").alias("cnt")) \
                .select(from_micros("_e").alias("window_end"), "cnt")


def window_ends(ts: str | Column, size_us: int, slide_us: int) -> tuple[Column, Column]:
    """First window end that covers ``ts`` and the first one after it that no longer does (epoch microseconds).

    Windows start on the slide grid, whether or not ``size`` is a multiple of ``slide``.
    """
    t = micros(ts)
    early = t - F.lit(size_us)
    return (early - F.pmod(early, F.lit(slide_us)) + F.lit(size_us + slide_us),
            t - F.pmod(t, F.lit(slide_us)) + F.lit(size_us + slide_us))


def _pane_deltas(df: DataFrame, keys: list[str], size_us: int, slide_us: int,
                 ts: str) -> DataFrame:
    first, past = window_ends(ts, size_us, slide_us)
    panes = df.where(F.col(ts).isNotNull()).groupBy(*keys, first.alias("_p"), past.alias("_q")).agg(
        F.count(F.lit(1)).alias("_c"))
    deltas = panes.select(*keys, F.explode(F.array(
        F.struct(F.col("_p").alias("e"), F.col("_c").alias("d")),
        F.struct(F.col("_q").alias("e"), (-F.col("_c")).alias("d")),
    )).alias("_x")).select(*keys, F.col("_x.e").alias("_e"), F.col("_x.d").alias("_d"))
    # zero-sum points would only split an interval of equal count: drop them
    return deltas.groupBy(*keys, "_e").agg(F.sum("_d").alias("_d")).filter(F.col("_d") != 0)


def sliding_count_sparse(df: DataFrame, keys: list[str], size, slide, ts: str = "ts",
                         carry_width=None) -> DataFrame:
    """O-27: long fine sliding windows as intervals of window ends with constant count.

    Returns keys, ``first_end``, ``last_end`` (inclusive, a whole number of slides later),
    ``n_windows`` and ``cnt``: every window ending at ``first_end``,
    ``first_end + slide``, .., ``last_end`` holds exactly ``cnt`` rows.
    Rows that share their first and last window are counted together and add
    ``+c`` at the first end and ``-c`` at the end after the last; the running
    sum of the deltas per key (a skew-safe keyed scan) is the window count.
    ``size`` need not be a multiple of ``slide``.
    """
    size_us, slide_us = us(size), us(slide)
    deltas = _pane_deltas(df, keys, size_us, slide_us, ts)
    width = us(carry_width) if carry_width is not None else size_us
    scanned = keyed_scan(deltas, keys, ["_e"], time_bucket(F.col("_e"), width),
                         next=["_e"], running=[Running("cnt", F.col("_d"), "sum")])
    out = scanned.filter((F.col("cnt") > 0) & F.col("next__e").isNotNull())
    n = ((F.col("next__e") - F.col("_e")) / F.lit(slide_us)).cast("bigint")
    return out.select(*keys, from_micros("_e").alias("first_end"),
                      from_micros(F.col("next__e") - F.lit(slide_us)).alias("last_end"),
                      n.alias("n_windows"), F.col("cnt").cast("bigint").alias("cnt"))


def sliding_count_dense(df: DataFrame, keys: list[str], size, slide, ts: str = "ts",
                        carry_width=None) -> DataFrame:
    """O-27 expanded: one row per (key, window) -> keys, window_start, window_end, cnt.

    The output has up to ``size/slide`` rows per pane, as the reference emits;
    prefer ``sliding_count_sparse`` unless every window is needed.
    """
    size_us, slide_us = us(size), us(slide)
    sp = sliding_count_sparse(df, keys, size, slide, ts, carry_width)
    e = F.explode(F.sequence(micros("first_end"), micros("last_end"), F.lit(slide_us)))
    ex = sp.select(*keys, "cnt", e.alias("_e"))
    return ex.select(*keys, from_micros(F.col("_e") - F.lit(size_us)).alias("window_start"),
                     from_micros("_e").alias("window_end"), "cnt")
