"""Late data against a bounded-out-of-orderness watermark (O-44..O-46), contract C9.

Arrival order is given by ``seq`` (and ``tie``).  The watermark seen by row
``i`` is ``max(ts of earlier rows) - bound``: a prefix maximum over the whole
stream, computed by a keyed scan without key whose buckets are chunks of the
arrival sequence (one summary row per chunk carries the maximum forward, itself
scanned in groups of chunks), so no task ever holds the stream.

For a row and a window ending at ``e`` (last instant ``e - 1us``):
``on_time`` if ``e - 1us > wm``; ``late_update`` if ``e - 1us <= wm`` and
``e - 1us + allowed > wm``; ``expired`` otherwise.  A row goes to the late side
output only if its last window is expired.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import from_micros, micros
from eventide.operators.scan import Running, keyed_scan
from eventide.operators.windows import us


CHUNK = 4096    # arrivals per bucket of the watermark scan


def _ceil_to(x, step: int):
    return x + F.pmod(-x, F.lit(step))


def with_watermark_before(df: DataFrame, bound, seq: str = "seq", tie: str | None = None,
                          ts: str = "ts", chunk: int = CHUNK,
                          initial_max_us: int | None = None) -> DataFrame:
    """Add ``wm_us``: the watermark in force when the row arrives (null for the first).

    ``initial_max_us`` is the largest event time seen before this input (a
    stream's earlier micro-batches, ``streaming.late``).
    """
    order = [seq] + ([tie] if tie else [])
    bucket = ((F.col(seq) - F.pmod(F.col(seq), F.lit(chunk))) / F.lit(chunk)).cast("bigint")
    sc = keyed_scan(df.withColumn("_ts_us", micros(ts)), [], order, bucket,
                    running=[Running("_max_before", F.col("_ts_us"), "max", "prefix", False)])
    mx = F.col("_max_before")
    if initial_max_us is not None:
        mx = F.greatest(mx, F.lit(initial_max_us))      # of a null and a value, the value
    return sc.withColumn("wm_us", mx - F.lit(us(bound))).drop("_max_before")


def window_ranges(df: DataFrame, size, slide, allowed) -> DataFrame:
    """Per row, the window-end ranges by status (epoch microseconds, on the slide grid).

    ``_first_end``/``_last_end``: all windows holding the row; windows from
    ``_acc_from`` are accepted (not expired); from ``_on_from`` on time.
    """
    size_us, slide_us, allowed_us = us(size), us(slide), us(allowed)
    t = F.col("_ts_us")
    first_end = t - F.pmod(t, F.lit(slide_us)) + F.lit(slide_us)
    last_end = first_end + F.lit(size_us - slide_us)
    wm = F.col("wm_us")
    # on time: e - 1 > wm  <=>  e >= wm + 2 ; accepted: e - 1 + allowed > wm  <=>  e >= wm - allowed + 2
    on_from = F.greatest(first_end, F.coalesce(_ceil_to(wm + F.lit(2), slide_us), first_end))
    acc_from = F.greatest(first_end, F.coalesce(_ceil_to(wm - F.lit(allowed_us) + F.lit(2), slide_us),
                                                first_end))
    return df.select("*", first_end.alias("_first_end"), last_end.alias("_last_end"),
                     acc_from.alias("_acc_from"), on_from.alias("_on_from"))


def late_classify(df: DataFrame, bound, allowed, size, slide, seq: str = "seq",
                  tie: str | None = None, ts: str = "ts", chunk: int = CHUNK) -> DataFrame:
    """O-46: one row per (row, window) with ``window_end``, ``status`` and ``wm``."""
    slide_us = us(slide)
    r = window_ranges(with_watermark_before(df, bound, seq, tie, ts, chunk), size, slide, allowed)
    e = F.explode(F.sequence("_first_end", "_last_end", F.lit(slide_us))).alias("_e")
    x = r.select("*", e)
    status = (F.when(F.col("_e") >= F.col("_on_from"), F.lit("on_time"))
              .when(F.col("_e") >= F.col("_acc_from"), F.lit("late_update"))
              .otherwise(F.lit("expired")))
    keep = [c for c in df.columns]
    return x.select(*keep, from_micros("_e").alias("window_end"), status.alias("status"),
                    from_micros("wm_us").alias("wm"))


def late_rows(df: DataFrame, bound, allowed, size, slide, seq: str = "seq",
              tie: str | None = None, ts: str = "ts", chunk: int = CHUNK) -> DataFrame:
    """O-46 side output: rows whose last window had already expired on arrival."""
    r = window_ranges(with_watermark_before(df, bound, seq, tie, ts, chunk), size, slide, allowed)
    return r.filter(F.col("_acc_from") > F.col("_last_end")).select(
        *df.columns, from_micros("wm_us").alias("wm"))


def lateness_runs(df: DataFrame, keys: list[str], bound, allowed, size, slide, seq: str = "seq",
                  tie: str | None = None, ts: str = "ts", chunk: int = CHUNK, span=None) -> DataFrame:
    """Runs of windows with constant counts: keys, ``span``, ``from_us``, ``to_us``, ``cnt`` and ``cnt_on_time``.

    Window ends are cut into spans (``span`` wide, an hour or the window's size).
    A row counts in each span that its accepted windows touch, as a change of
    the count at the first and one after the last of them there; changes are
    summed per (key, span, end) and run up inside the span.  A span needs nothing
    of the span before, so the watermark scan is in the plan once; a group holds at most one
    row per window end of a span.
    """
    slide_us = us(slide)
    width = us(span) if span is not None else max(us(size), 3_600_000_000)
    r = window_ranges(with_watermark_before(df, bound, seq, tie, ts, chunk), size, slide, allowed)
    r = r.filter(F.col("_acc_from") <= F.col("_last_end"))
    of = [F.floor(F.col(c) / F.lit(width)).cast("bigint") for c in ("_acc_from", "_last_end")]
    r = r.withColumn("_span", F.explode(F.sequence(*of)))
    start, stop = F.col("_span") * F.lit(width), (F.col("_span") + 1) * F.lit(width)
    lo, beyond = F.greatest("_acc_from", _ceil_to(start, slide_us)), F.col("_last_end") + F.lit(slide_us)
    on = F.greatest("_on_from", lo)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    has_on = (on <= F.col("_last_end")) & (on < stop)
    changes = F.filter(F.array(
        F.struct(lo.alias("e"), one.alias("d"), F.when(on == lo, one).otherwise(zero).alias("o")),
        F.struct(F.when(has_on & (on > lo), on).alias("e"), zero.alias("d"), one.alias("o")),
        F.struct(F.when(beyond < stop, beyond).alias("e"), (-one).alias("d"),
                 F.when(has_on, -one).otherwise(zero).alias("o"))), lambda c: c["e"].isNotNull())
    r = r.where((lo <= F.col("_last_end")) & (lo < stop))
    by = r.select(*keys, "_span", F.explode(changes).alias("_c")).groupBy(*keys, "_span", F.col("_c.e").alias("from_us")) \
        .agg(F.sum("_c.d").alias("_d"), F.sum("_c.o").alias("_o")).where("_d <> 0 or _o <> 0")
    w = Window.partitionBy(*keys, "_span").orderBy("from_us")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = F.coalesce(F.lead("from_us").over(w), _ceil_to((F.col("_span") + 1) * F.lit(width), slide_us))
    return by.select(*keys, F.col("_span").alias("span"), "from_us", (after - F.lit(slide_us)).alias("to_us"),
                     F.sum("_d").over(upto).alias("cnt"), F.sum("_o").over(upto).alias("cnt_on_time")).where("cnt > 0")


def lateness_counts(df: DataFrame, keys: list[str], bound, allowed, size, slide,
                    seq: str = "seq", tie: str | None = None, ts: str = "ts",
                    chunk: int = CHUNK, span=None) -> DataFrame:
    """O-45: per (key, window) the count at the on-time firing and after late updates.

    The windows of :func:`lateness_runs`, one row each.
    Output: keys, window_end, cnt_on_time, cnt (final), late_updates.
    """
    runs = lateness_runs(df, keys, bound, allowed, size, slide, seq, tie, ts, chunk, span)
    wins = runs.select(*keys, "cnt", "cnt_on_time", F.explode(F.sequence(
        "from_us", "to_us", F.lit(us(slide)))).alias("_w"))
    return wins.select(*keys, from_micros("_w").alias("window_end"), "cnt_on_time", "cnt",
                       (F.col("cnt") - F.col("cnt_on_time")).alias("late_updates"))
