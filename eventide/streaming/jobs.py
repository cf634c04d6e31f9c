"""Streaming twins of the batch jobs (Structured Streaming, event time).

Each function takes the raw ``events`` stream (``testdata.events_stream``),
declares event time and returns a streaming DataFrame; ``sinks.run_stream``
runs it.  Catalyst moves a job's type filter below the watermark, so the
watermark follows the job's own rows, not those it filters out.
Windowed counts run in ``append`` mode (a window is emitted once, when the
watermark closes it); keyed state machines run through
``transformWithState``; the two-stream interval join is a stream-stream join
whose state the watermark bounds.  Contract C10: at the end of a finite input
only what the watermark closed is emitted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import local_day, micros
from eventide.operators.topn import topn_per_window
from eventide.sources import testdata as td
from eventide.streaming.event_time import with_event_time
from eventide.streaming.processors import (FailureBurstsMachine, FailurePairsMachine,
                                           FunnelMachine, OrderStatusMachine, ProcessingTimeCap, RateCapMachine,
                                           ReconcileMachine, SequenceMachine, by_bucket, run_ordered)

EV = ("ts_us", "event_time")
DAY_US = 86_400_000_000
WEEK = 7        # days of a key that one group of state holds: each group costs about a dozen calls into the state


def stream_hot_item_counts(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes",
                           delay: str = "0 seconds") -> DataFrame:
    """O-26 S: item views per sliding window, emitted when the window closes."""
    ev = with_event_time(events, "ts", delay)
    pv = td.user_behavior_from(ev, keep=EV).filter(F.col("behavior") == "pv")
    agg = pv.groupBy("item_id", F.window("event_time", size, slide).alias("w")).count()
    return agg.select("item_id", F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                      F.col("count").alias("cnt"))


def topn_batch_writer(path: str, n: int, key: str) -> Callable:
    """O-34 S: ``foreachBatch`` top-n of the windows closed in the batch, appended to parquet.

    In append mode every window arrives in exactly one batch with its final
    count, so the per-batch ranking is final.  Rewrites are idempotent per
    batch id (one sub-folder per batch).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        topn_per_window(batch, n, key).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def stream_uv(events: DataFrame, size: str = "1 hour") -> DataFrame:
    """O-29 S: distinct users per window by two chained aggregations (append mode)."""
    ev = with_event_time(events, "ts", "0 seconds").filter(F.col("event_type") == "view")
    per_user = ev.groupBy(F.window("event_time", size).alias("w"), "user_id").count()
    per_win = per_user.groupBy("w").agg(F.count(F.lit(1)).alias("uv"))
    return per_win.select(F.col("w.end").cast("timestamp_ntz").alias("window_end"), "uv")


def stream_tx_join(events: DataFrame, lower_s: int, upper_s: int) -> DataFrame:
    """O-40 S: stream-stream interval join of pays and receipts on the transaction id."""
    ev = with_event_time(events, "ts", "0 seconds")
    pays = td.order_events_from(ev, keep=EV).filter(F.col("event_type") == "pay") \
        .select("tx_id", "order_id", F.col("ts").alias("pay_ts"), F.col("event_time").alias("pay_time"))
    rec = td.receipts_from(ev, keep=EV).select(F.col("tx_id").alias("r_tx_id"), "pay_channel",
                                               F.col("ts").alias("receipt_ts"),
                                               F.col("event_time").alias("receipt_time"))
    cond = ((F.col("tx_id") == F.col("r_tx_id"))
            & (F.col("receipt_time") >= F.col("pay_time") - F.expr(f"INTERVAL {-lower_s} SECONDS"))
            & (F.col("receipt_time") <= F.col("pay_time") + F.expr(f"INTERVAL {upper_s} SECONDS")))
    return pays.join(rec, cond, "inner").select("tx_id", "order_id", "pay_ts", "pay_channel", "receipt_ts")


def stream_tx_outer(events: DataFrame, lower_s: int, upper_s: int) -> DataFrame:
    """O-42 S: the interval join with the rows of both sides that found no partner, as a stream-stream full outer join.

    For transactions whose ids are unique on each side this is the reconciliation:
    ``tag`` is ``MATCH`` or ``UNMATCHED``.  A row without a partner comes out once
    the watermark, the lesser of the two sides', has passed the last instant at
    which one could come; until then it is state.  Where ids repeat, every pair
    in the interval is a match (one-to-one: :func:`stream_reconcile`).
    """
    pays = td.order_events_from(with_event_time(events, "ts", "0 seconds"), keep=EV).filter(F.col("event_type") == "pay") \
        .select("tx_id", "order_id", F.col("ts").alias("pay_ts"), F.col("seq").alias("pay_seq"),
                F.col("event_time").alias("pay_time"))
    rec = td.receipts_from(with_event_time(events, "ts", "0 seconds"), keep=EV).select(
        F.col("tx_id").alias("r_tx_id"), "pay_channel", F.col("ts").alias("receipt_ts"),
        F.col("seq").alias("receipt_seq"), F.col("event_time").alias("receipt_time"))
    cond = ((F.col("tx_id") == F.col("r_tx_id"))
            & (F.col("receipt_time") >= F.col("pay_time") - F.expr(f"INTERVAL {-lower_s} SECONDS"))
            & (F.col("receipt_time") <= F.col("pay_time") + F.expr(f"INTERVAL {upper_s} SECONDS")))
    both = F.col("pay_seq").isNotNull() & F.col("receipt_seq").isNotNull()
    return pays.join(rec, cond, "full_outer").select(
        F.when(both, F.lit("MATCH")).otherwise(F.lit("UNMATCHED")).alias("tag"),
        F.coalesce("tx_id", "r_tx_id").alias("tx_id"), "order_id", "pay_ts", "pay_seq", "pay_channel", "receipt_ts",
        "receipt_seq")


def _ordered_input(df: DataFrame, tie: F.Column | None = None) -> DataFrame:
    return df.withColumn("tie", tie if tie is not None else F.lit(0))


def stream_order_status(events: DataFrame, timeout_us: int, forget_us: int | None = None) -> DataFrame:
    """O-36 S: create/pay state machine per order (C6), ``transformWithState``.

    An unpaid create is reported at ``create + timeout``; where it is paid after
    that, the report is taken back (``op`` ``-``) and the pay is
    ``paid_after_timeout``, however late (within ``forget_us`` where given, which
    bounds the state).  ``sinks.net_rows`` of the output are the batch job's rows.
    """
    ev = with_event_time(events, "ts", "0 seconds")
    od = _ordered_input(td.order_events_from(ev, keep=EV),
                        F.when(F.col("event_type") == "create", F.lit(0)).otherwise(F.lit(1)))
    out = run_ordered(od, ["order_id"], OrderStatusMachine(timeout_us, forget_us),
                      ["event_type", "ts_us", "tie", "seq"],
                      "event_type string, ts_us long, tie int, seq long")
    return _us_to_ts(out, {"create_us": "create_ts", "pay_us": "pay_ts"})


def stream_sequence(rows: DataFrame, key: str, key_ddl: str, steps: list, within_us: int,
                    inclusive: bool = False) -> DataFrame:
    """O-35 S: ``patterns.match_sequence`` over a stream, for any number of ``patterns.Step``.

    ``rows`` carries ``ts_us``, ``seq`` and a watermark.  Same columns as the batch
    operator; a sequence is emitted when it is complete, broken or out of time.
    """
    fits = F.lit(0)
    for i, s in enumerate(steps):
        fits = fits + F.coalesce(s.where, F.lit(False)).cast("int") * (1 << i)
    d = by_bucket(_ordered_input(rows.where("ts_us is not null")).withColumn("fits", fits),
                  max(within_us, WEEK * DAY_US), back_us=within_us)
    names = [s.name for s in steps]
    out = run_ordered(d, [key, "bucket"], SequenceMachine(names, [s.follows for s in steps], within_us, inclusive,
                                                          key_ddl),
                      ["fits", "home", "ts_us", "tie", "seq"],
                      "fits int, home boolean, ts_us long, tie int, seq long")
    return _us_to_ts(out, {f"{n}_us": f"{n}_ts" for n in names})


def stream_uv_chunks(events: DataFrame, size: str = "1 hour", delay: str | None = None) -> DataFrame:
    """O-31 / O-52 S: per window and 32K-bit chunk of user hashes the bits set so far, in ``update`` mode.

    The state is the bitmaps themselves, merged per micro-batch; each micro-batch
    emits the chunks that it changed.  A window's count is the sum of its chunks'
    latest (:func:`latest_uv`).  With ``delay`` the state of a window ends when the
    watermark passes it; without, all windows stay and can be read back
    (``sinks.read_state``).
    """
    from eventide.operators.uniques import user_hash
    ev = events.where("ts is not null and event_type = 'view'")
    ev = with_event_time(ev, "ts", delay) if delay else ev.withColumn("event_time", F.timestamp_micros(micros("ts")))
    h = user_hash("user_id")
    agg = ev.groupBy(F.window("event_time", size).alias("w"), F.bitmap_bucket_number(h).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias("bits"))
    return agg.select(F.col("w.end").cast("timestamp_ntz").alias("window_end"), "chunk",
                      F.bitmap_count("bits").alias("uv"))


def latest_uv(chunks: DataFrame) -> DataFrame:
    """``(window_end, uv)`` from the updates of :func:`stream_uv_chunks`, whose ``batch`` says which is the latest."""
    last = chunks.groupBy("window_end", "chunk").agg(F.max_by("uv", "batch").alias("uv"))
    return last.groupBy("window_end").agg(F.sum("uv").alias("uv"))


def stream_ad_cap_by_clock(clicks: DataFrame, n: int, tz: str = "Asia/Shanghai", every_ms: int | None = None) -> DataFrame:
    """O-51 S: the click cap whose counts the processing time resets, at midnight of ``tz`` (or every ``every_ms``).

    ``clicks`` has user_id, ad_id, ts_us and seq.
    """
    return clicks.select("user_id", "ad_id", "ts_us", "seq").groupBy("user_id", "ad_id").transformWithState(
        ProcessingTimeCap(n, tz, every_ms), "user_id long, ad_id long, tag string, ts_us long, seq long, msg string",
        "update", "ProcessingTime")


def stream_order_funnel(events: DataFrame, within_us: int) -> DataFrame:
    """O-35 / O-35b S: create followed by pay within the bound; time-outs by event-time timer."""
    ev = with_event_time(events, "ts", "0 seconds")
    od = _ordered_input(td.order_events_from(ev, keep=EV),
                        F.when(F.col("event_type") == "create", F.lit(0)).otherwise(F.lit(1)))
    od = by_bucket(od, max(within_us, WEEK * DAY_US), back_us=within_us, halo=F.col("event_type") == "pay")
    out = run_ordered(od, ["order_id", "bucket"], FunnelMachine(within_us), ["event_type", "ts_us", "tie", "seq"],
                      "event_type string, ts_us long, tie int, seq long")
    return _us_to_ts(out, {"create_us": "create_ts", "pay_us": "pay_ts", "timeout_us": "timeout_ts"})


def stream_reconcile(events: DataFrame, wait_pay_us: int, wait_receipt_us: int) -> DataFrame:
    """O-41 / O-42 S: pays and receipts merged per transaction, matched one to one."""
    # a watermark of its own for each side: the job's is the lesser of the two
    pays = td.order_events_from(with_event_time(events, "ts", "0 seconds"), keep=EV).filter(F.col("event_type") == "pay") \
        .select("tx_id", "order_id", F.lit(None).cast("string").alias("pay_channel"),
                "ts_us", F.lit(0).alias("tie"), "seq", "event_time")
    rec = td.receipts_from(with_event_time(events, "ts", "0 seconds"), keep=EV).select(
        "tx_id", F.lit(None).cast("bigint").alias("order_id"), "pay_channel", "ts_us",
        F.lit(1).alias("tie"), "seq", "event_time")
    both = pays.unionByName(rec)
    out = run_ordered(both, ["tx_id"], ReconcileMachine(wait_pay_us, wait_receipt_us),
                      ["order_id", "pay_channel", "ts_us", "tie", "seq"],
                      "order_id long, pay_channel string, ts_us long, tie int, seq long")
    return _us_to_ts(out, {"pay_us": "pay_ts", "receipt_us": "receipt_ts"})


def stream_login_pairs(events: DataFrame, within_us: int) -> DataFrame:
    """O-38 S: consecutive failure pairs per user."""
    ev = with_event_time(events, "ts", "0 seconds")
    lg = by_bucket(_ordered_input(td.logins_from(ev, keep=EV)), max(within_us, WEEK * DAY_US), ahead_us=within_us)
    out = run_ordered(lg, ["user_id", "bucket"], FailurePairsMachine(within_us),
                      ["event_type", "ts_us", "tie", "seq", "home"],
                      "event_type string, ts_us long, tie int, seq long, home boolean")
    return _us_to_ts(out, {"first_us": "first_fail_ts", "last_us": "last_fail_ts"})


def stream_login_bursts(events: DataFrame, n: int, within_us: int) -> DataFrame:
    """O-37 S: failure bursts per user, closed by event-time timers."""
    ev = with_event_time(events, "ts", "0 seconds")
    lg = _ordered_input(td.logins_from(ev, keep=EV))
    out = run_ordered(lg, ["user_id"], FailureBurstsMachine(n, within_us),
                      ["event_type", "ts_us", "tie", "seq"], "event_type string, ts_us long, tie int, seq long")
    return _us_to_ts(out, {"first_us": "first_fail_ts", "last_us": "last_fail_ts"})


def stream_ad_cap(spark: SparkSession, sf_dir: str, events: DataFrame, n: int,
                  tz: str = "Asia/Shanghai") -> DataFrame:
    """O-33 S: daily click cap per (user, ad); rows tagged PASS / WARN."""
    ev = with_event_time(events, "ts", "0 seconds")
    clicks = _ordered_input(td.ad_clicks_from(spark, sf_dir, ev, keep=EV)) \
        .where("ts is not null").withColumn("click_day", local_day("ts", tz).cast("string")) \
        .withColumn("bucket", F.floor(F.datediff("click_day", F.lit("1970-01-01")) / F.lit(WEEK)))
    out = run_ordered(clicks, ["user_id", "ad_id", "bucket"], RateCapMachine(n, tz),
                      ["province", "city", "click_day", "ts_us", "tie", "seq"],
                      "province string, city string, click_day string, ts_us long, tie int, seq long")
    return _us_to_ts(out, {"ts_us": "ts"})


def _us_to_ts(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    for src, dst in cols.items():
        df = df.withColumn(dst, F.timestamp_add("MICROSECOND", F.col(src), epoch)).drop(src)
    return df
