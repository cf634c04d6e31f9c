"""The registered queries: each reads the test tables under ``sf_dir`` and runs
one reference job (or one operator of it) over the whole input.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle of the same name in ``eventide.plans.oracle``.
Parameters are the reference's, except where the test data's time scale
needs hours instead of seconds (users are ~11 h apart): login windows 6 h,
order time-out 24 h, transaction bounds -3 h..+5 h and patience 5 h / 3 h,
click cap 1 per day.  See ``eventide.sources.testdata`` for the mapping.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.text import drop_static_assets, exclude, only
from eventide.functions.time import from_micros, ntz_literal
from eventide.session import DEFAULT_CONF, scratch_path, use_utc
from eventide.operators import caps, late, patterns, reconcile, runs, topn, uniques, windows
from eventide.sources import files, testdata as td
from eventide.streaming import changelog as slog, jobs, late as slate, sinks
from eventide.streaming.event_time import with_event_time
from eventide.streaming.sinks import run_stream

H = dt.timedelta(hours=1)
MIN = dt.timedelta(minutes=1)
SEC = dt.timedelta(seconds=1)
DAY = dt.timedelta(days=1)

# ---- parameters per job ---------------------------------------------------
HOT_ITEMS = dict(size=H, slide=5 * MIN, n=5)
HOT_PAGES = dict(size=10 * MIN, slide=5 * SEC, bound=3 * MIN, allowed=MIN, n=3)
LATE = dict(size=H, slide=10 * MIN, bound=30 * MIN, allowed=30 * MIN)
MARKET = dict(size=DAY, slide=5 * SEC)
AD_CAP = 1
AD_TZ = "Asia/Shanghai"
LOGIN_WITHIN = 6 * H
BURST_N = 2
ORDER_TIMEOUT = 24 * H
TX_LOWER, TX_UPPER = -3 * H, 5 * H
TX_WAIT_PAY, TX_WAIT_RECEIPT = 5 * H, 3 * H
CHANGELOG_CUTOFF = dt.datetime(2024, 1, 16)
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _pv(spark, sf):
    return only(td.user_behavior(spark, sf, ["pv"]), "behavior", "pv")


def parse_behavior(spark, sf):
    lines = td.behavior_lines(spark, sf)
    parsed = files.parse_user_behavior(lines)
    return _clean(only(parsed, "behavior", "pv"))


def _clean(parsed):
    """Parsed rows without the malformed lines (those are tagged ``_corrupt``)."""
    return parsed.filter(~F.col("_corrupt")).drop("_corrupt")


def parse_ad_click(spark, sf):
    return _clean(files.parse_ad_click(td.csv_lines(
        td.ad_clicks(spark, sf), "user_id", "ad_id", "province", "city")))


def parse_login(spark, sf):
    return _clean(files.parse_login(td.csv_lines(td.logins(spark, sf), "user_id", "ip", "event_type")))


def parse_order(spark, sf):
    return _clean(files.parse_order(td.csv_lines(td.order_events(spark, sf), "order_id", "event_type", "tx_id")))


def parse_receipt(spark, sf):
    return _clean(files.parse_receipt(td.csv_lines(td.receipts(spark, sf), "tx_id", "pay_channel")))


def access_log_parse(spark, sf):
    return files.parse_access_log(td.access_log_lines(spark, sf)).filter(
        ~F.col("_corrupt")).drop("_corrupt")


def _page_requests(spark, sf):
    lines = td.access_log_lines(spark, sf)
    parsed = files.parse_access_log(lines, keep=("seq", "event_id"))
    return drop_static_assets(only(parsed, "method", "GET"), "url")


def static_filter(spark, sf):
    return _page_requests(spark, sf).select("ip", "user_id", "ts", "method", "url")


def channel_exclude(spark, sf):
    return exclude(td.market_events(spark, sf), "behavior", "uninstall") \
        .select("user_id", "behavior", "channel", "ts")


def hot_items_counts(spark, sf):
    return windows.sliding_count(_pv(spark, sf), ["item_id"], HOT_ITEMS["size"], HOT_ITEMS["slide"])


def hot_items_topn(spark, sf):
    c = hot_items_counts(spark, sf)
    return topn.topn_per_window(c, HOT_ITEMS["n"], "item_id").select("item_id", "window_end", "cnt", "rank")


def hot_items_sql(spark, sf):
    return topn.hot_items_sql(spark, td.user_behavior(spark, sf), HOT_ITEMS["n"])


def ranking_report(spark, sf):
    return topn.ranking_report(hot_items_topn(spark, sf), "item_id")


def topn_changelog(spark, sf, cutoff: dt.datetime = CHANGELOG_CUTOFF):
    """Rows that turn the ranking of the events before ``cutoff`` into that of all events."""
    pv = _pv(spark, sf)
    cut = ntz_literal(cutoff.strftime("%Y-%m-%d %H:%M:%S"))

    def top(df):
        c = windows.sliding_count(df, ["item_id"], HOT_ITEMS["size"], HOT_ITEMS["slide"])
        return topn.topn_per_window(c, HOT_ITEMS["n"], "item_id").select("item_id", "window_end", "cnt", "rank")

    return topn.changelog(top(pv.filter(F.col("ts") < cut)), top(pv))


def pv_hourly(spark, sf):
    return windows.pv_per_window(_pv(spark, sf), H)


def pv_salted(spark, sf):
    return windows.pv_salted(_pv(spark, sf), H, n=10, salt_cols=["seq"])


def uv_exact(spark, sf):
    return uniques.uv_exact(_pv(spark, sf), H)


def uv_bitmap(spark, sf):
    return uniques.uv_bitmap(_pv(spark, sf), H)


def uv_running(spark, sf):
    return uniques.uv_running(_pv(spark, sf), H)


def hot_pages_counts(spark, sf):
    p = HOT_PAGES
    return late.lateness_counts(_page_requests(spark, sf), ["url"], p["bound"], p["allowed"],
                                p["size"], p["slide"], seq="seq", tie="event_id")


def hot_pages_topn(spark, sf):
    p = HOT_PAGES
    counts = late.lateness_runs(_page_requests(spark, sf), ["url"], p["bound"], p["allowed"],
                                p["size"], p["slide"], seq="seq", tie="event_id")
    best = runs.topn_of_runs(counts, "url", p["n"], p["slide"])
    return runs.windows_of_runs(best, p["slide"]).select("url", "window_end", "cnt", "rank")


def _late_events(spark, sf):
    e = td.events(spark, sf)
    return e.select("event_id", "ts", "event_type", td.late_arrival_seq().alias("seq"))


def late_classify(spark, sf):
    p = LATE
    return late.late_classify(_late_events(spark, sf), p["bound"], p["allowed"], p["size"],
                              p["slide"], seq="seq", tie="event_id") \
        .select("event_id", "ts", "seq", "window_end", "status")


def late_rows(spark, sf):
    p = LATE
    return late.late_rows(_late_events(spark, sf), p["bound"], p["allowed"], p["size"], p["slide"],
                          seq="seq", tie="event_id").select("event_id", "ts", "seq", "wm")


def lateness_counts(spark, sf):
    p = LATE
    return late.lateness_counts(_late_events(spark, sf), ["event_type"], p["bound"], p["allowed"],
                                p["size"], p["slide"], seq="seq", tie="event_id")


def channel_sliding(spark, sf):
    m = exclude(td.market_events(spark, sf), "behavior", "uninstall")
    return windows.sliding_count_sparse(m, ["channel", "behavior"], MARKET["size"], MARKET["slide"])


def channel_sliding_dense(spark, sf):
    """Every window of every key, as the reference emits them; hourly slides keep the output near the input."""
    kept = exclude(td.market_events(spark, sf), "behavior", "uninstall")
    return windows.sliding_count_dense(kept, ["channel", "behavior"], MARKET["size"], H)


def _ad_ranked(spark, sf):
    r = caps.rate_cap(td.ad_clicks(spark, sf), ["user_id", "ad_id"], AD_CAP, AD_TZ)
    return r.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def ad_passed(spark, sf):
    return caps.cap_passed(_ad_ranked(spark, sf), AD_CAP) \
        .select("user_id", "ad_id", "province", "city", "ts", "day")


def ad_warnings(spark, sf):
    return caps.cap_warnings(_ad_ranked(spark, sf), ["user_id", "ad_id"], AD_CAP)


def ad_province(spark, sf):
    passed = caps.cap_passed(_ad_ranked(spark, sf), AD_CAP)
    return windows.sliding_count_sparse(passed, ["province"], MARKET["size"], MARKET["slide"])


def login_bursts(spark, sf):
    return patterns.failure_bursts(td.logins(spark, sf), BURST_N, LOGIN_WITHIN)


def login_pairs(spark, sf):
    return patterns.failure_pairs(td.logins(spark, sf), LOGIN_WITHIN, inclusive=True)


def login_pattern(spark, sf):
    return patterns.failure_pattern(td.logins(spark, sf), LOGIN_WITHIN, inclusive=False)


def _relief_steps():
    """A failure, the very next event a failure too, and a success any time later."""
    is_fail = F.col("event_type") == "fail"
    return [patterns.Step("first", is_fail), patterns.Step("second", is_fail, "next"),
            patterns.Step("relief", F.col("event_type") == "success")]


def sequence_3step(spark, sf):
    """Two failures in a row and a later success, within a day of the first."""
    return patterns.match_sequence(td.logins(spark, sf), ["user_id"], _relief_steps(), DAY)


def _funnel(spark, sf):
    return patterns.order_funnel(td.order_events(spark, sf), ORDER_TIMEOUT)


def order_paid(spark, sf):
    return _funnel(spark, sf).filter(F.col("tag") == "PAY") \
        .select("order_id", "create_ts", "pay_ts", "msg")


def order_timeouts(spark, sf):
    return _funnel(spark, sf).filter(F.col("tag") == "TIMEOUT") \
        .select("order_id", "create_ts", "timeout_ts", "msg")


def order_status(spark, sf):
    return patterns.order_status(td.order_events(spark, sf), ORDER_TIMEOUT)


def _pays(spark, sf):
    return only(td.order_events(spark, sf), "event_type", "pay")


def tx_interval_join(spark, sf):
    pays = _pays(spark, sf).select("tx_id", "order_id", F.col("ts").alias("pay_ts"))
    rec = td.receipts(spark, sf).select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts"))
    return reconcile.interval_join(pays, rec, ["tx_id"], TX_LOWER, TX_UPPER,
                                   lts="pay_ts", rts="receipt_ts")


def tx_outer_join(spark, sf):
    """The interval join with the pays and receipts that found no partner."""
    pays = _pays(spark, sf).select("tx_id", "order_id", F.col("ts").alias("pay_ts"), F.col("seq").alias("pay_seq"))
    rec = td.receipts(spark, sf).select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts"),
                                        F.col("seq").alias("receipt_seq"))
    out = reconcile.interval_join(pays, rec, ["tx_id"], TX_LOWER, TX_UPPER, how="full", lts="pay_ts", rts="receipt_ts",
                                  left_id=["pay_seq"], right_id=["receipt_seq"])
    both = F.col("pay_seq").isNotNull() & F.col("receipt_seq").isNotNull()
    return out.withColumn("tag", F.when(both, F.lit("MATCH")).otherwise(F.lit("UNMATCHED")))


def _reconciled(spark, sf):
    pays = _pays(spark, sf).select("tx_id", "order_id", "ts", "seq")
    rec = td.receipts(spark, sf).select("tx_id", "pay_channel", "ts", "seq")
    return reconcile.reconcile(pays, rec, "tx_id", TX_WAIT_PAY, TX_WAIT_RECEIPT,
                               ["order_id", "ts", "seq"], ["pay_channel", "ts", "seq"])


def _flat_reconciled(df):
    return df.select("tx_id", F.col("left.order_id").alias("order_id"),
                     F.col("left.ts").alias("pay_ts"), F.col("left.seq").alias("pay_seq"),
                     F.col("right.pay_channel").alias("pay_channel"),
                     F.col("right.ts").alias("receipt_ts"), F.col("right.seq").alias("receipt_seq"))


def tx_matched(spark, sf):
    return _flat_reconciled(_reconciled(spark, sf).filter(F.col("tag") == "MATCH"))


def tx_unmatched(spark, sf):
    return _flat_reconciled(_reconciled(spark, sf).filter(F.col("tag") == "UNMATCHED"))


def _events_stream(spark, sf):
    """The events table as a stream, its state in the library's default store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   DEFAULT_CONF["spark.sql.streaming.stateStore.providerClass"])
    # as a pattern, which the file source also takes where the table is a single file
    return td.events_stream(spark, f"{sf.rstrip('/')}/events.parque[t]")


def _stream_table(spark, sf, name, job):
    """The sink table of an ``availableNow`` run of ``job`` over the events stream (contract C10).

    Only what the watermark closed is in it, so the last instants of the input are not.
    """
    return _drained(spark, name, job(_events_stream(spark, sf)))


def _drained(spark, name, out):
    path = scratch_path(spark, name)
    run_stream(out, "parquet", name=name, options={"path": path})
    return spark.read.schema(out.schema).parquet(path)


def stream_hot_items(spark, sf):
    """Rankings of the windows the stream has closed."""
    counts = _stream_table(spark, sf, "stream_hot_items", jobs.stream_hot_item_counts)
    return topn.topn_per_window(counts, HOT_ITEMS["n"], "item_id").select("item_id", "window_end", "cnt", "rank")


def stream_uv(spark, sf):
    return _stream_table(spark, sf, "stream_uv", jobs.stream_uv)


def stream_tx_join(spark, sf):
    secs = (int(d.total_seconds()) for d in (TX_LOWER, TX_UPPER))
    return _stream_table(spark, sf, "stream_tx_join", lambda e: jobs.stream_tx_join(e, *secs))


def stream_tx_outer(spark, sf):
    """Matches, and the rows without a partner whose time for one the watermark has passed."""
    secs = (int(d.total_seconds()) for d in (TX_LOWER, TX_UPPER))
    return _stream_table(spark, sf, "stream_tx_outer", lambda e: jobs.stream_tx_outer(e, *secs))


def stream_changelog(spark, sf):
    """The ranking that the add and retract rows of the stream leave."""
    out = slog.stream_changelog(td.user_behavior_from(_events_stream(spark, sf)).filter(F.col("behavior") == "pv"),
                                "item_id", "item_id long", HOT_ITEMS["n"], HOT_ITEMS["size"], HOT_ITEMS["slide"])
    return sinks.net_rows(_drained(spark, "stream_changelog", out)).select("item_id", "window_end", "cnt", "rank")


def stream_login_pairs(spark, sf):
    return _stream_table(spark, sf, "stream_login_pairs", lambda e: jobs.stream_login_pairs(
        e, windows.us(LOGIN_WITHIN))).select("user_id", "first_fail_ts", "last_fail_ts", "warn_msg")


def stream_order_paid(spark, sf):
    out = _stream_table(spark, sf, "stream_order_paid", lambda e: jobs.stream_order_funnel(
        e, windows.us(ORDER_TIMEOUT)))
    return out.filter(F.col("tag") == "PAY").select("order_id", "create_ts", "pay_ts")


def stream_ad_passed(spark, sf):
    out = _stream_table(spark, sf, "stream_ad_passed", lambda e: jobs.stream_ad_cap(spark, sf, e, AD_CAP, AD_TZ))
    return out.filter(F.col("tag") == "PASS").select("user_id", "ad_id", "province", "city", "ts", "day")


def stream_order_status(spark, sf):
    """Statuses with default arguments; reports that a later pay took back are not among them."""
    return sinks.net_rows(_stream_table(spark, sf, "stream_order_status", lambda e: jobs.stream_order_status(
        e, windows.us(ORDER_TIMEOUT))))


def stream_login_bursts(spark, sf):
    return _stream_table(spark, sf, "stream_login_bursts", lambda e: jobs.stream_login_bursts(
        e, BURST_N, windows.us(LOGIN_WITHIN)))


def _stream_reconciled(spark, sf, tag):
    out = _stream_table(spark, sf, f"stream_tx_{tag.lower()}", lambda e: jobs.stream_reconcile(
        e, windows.us(TX_WAIT_PAY), windows.us(TX_WAIT_RECEIPT)))
    return out.filter(F.col("tag") == tag).drop("tag")


def stream_tx_matched(spark, sf):
    return _stream_reconciled(spark, sf, "MATCH")


def stream_tx_unmatched(spark, sf):
    return _stream_reconciled(spark, sf, "UNMATCHED")


def stream_sequence_3step(spark, sf):
    """Complete sequences of ``sequence_3step``."""
    def job(e):
        rows = td.logins_from(with_event_time(e, "ts", "0 seconds"), keep=jobs.EV)
        return jobs.stream_sequence(rows, "user_id", "user_id long", _relief_steps(), windows.us(DAY))
    return _stream_table(spark, sf, "stream_sequence_3step", job).filter(F.col("tag") == "MATCH")


def _split(spark, sf, name, rows, p, seq="seq", counts=None):
    path = scratch_path(spark, name)
    slate.split_late(rows, path, p["bound"], p["allowed"], p["size"], p["slide"], seq=seq, tie="event_id", name=name,
                     counts=counts)
    return path


def _late_stream(spark, sf):
    return _events_stream(spark, sf).select("event_id", "ts", "event_type", td.late_arrival_seq().alias("seq"))


LATE_DDL = "event_id long, ts timestamp_ntz, event_type string, seq long"


def stream_late_rows(spark, sf):
    """The side output of the classifying stream."""
    path = _split(spark, sf, "stream_late_rows", _late_stream(spark, sf), LATE)
    return spark.read.schema(f"{LATE_DDL}, wm timestamp_ntz").option("recursiveFileLookup", "true").parquet(
        f"{path}/late").select("event_id", "ts", "seq", "wm")


def stream_lateness_counts(spark, sf):
    """The last firing of every window that the contract's watermark has closed."""
    path = _split(spark, sf, "stream_lateness", _late_stream(spark, sf), LATE, counts=["event_type"])
    rows = slate.accepted_rows(spark, path, "event_type string, n long")
    out = _drained(spark, "stream_lateness_counts", slate.stream_lateness_counts(
        rows, ["event_type"], LATE["allowed"], LATE["slide"], "event_type string"))
    last = out.groupBy("event_type", "window_end_us").agg(F.max_by(
        F.struct("cnt_on_time", "cnt", "late_updates"), "version").alias("c"))
    return last.select("event_type", from_micros("window_end_us").alias("window_end"), "c.*")


PAGES_DDL = "ip string, user_id string, ts timestamp_ntz, method string, url string, seq long, event_id long"


def stream_hot_pages(spark, sf):
    """The last refined ranking of every window whose span the contract's watermark has closed."""
    p = HOT_PAGES
    parsed = files.parse_access_log(td.access_log_lines_from(_events_stream(spark, sf)), keep=("seq", "event_id"))
    pages = drop_static_assets(only(parsed, "method", "GET"), "url").select(
        "ip", "user_id", "ts", "method", "url", "seq", "event_id")
    rows = slate.accepted_rows(spark, _split(spark, sf, "stream_pages", pages, p), PAGES_DDL)
    out = _drained(spark, "stream_hot_pages", slate.stream_hot_pages(
        rows, "url", p["n"], p["allowed"], p["slide"], p["size"]))
    return slate.last_rankings(out, "url", p["n"], p["slide"]).select("url", "window_end", "cnt", "rank")


def stream_uv_running(spark, sf):
    """The last count of every window of the running visitors stream."""
    path = scratch_path(spark, "stream_uv_running")
    run_stream(jobs.stream_uv_chunks(_events_stream(spark, sf)), sinks.latest_batches(path), "update", "stream_uv_running")
    return jobs.latest_uv(spark.read.schema("window_end timestamp_ntz, chunk long, uv long, batch long").parquet(path))


def stream_uvcount(spark, sf):
    """The visitors per window as the running stream's state holds them, read back from its state store."""
    ckpt = scratch_path(spark, "stream_uvcount")
    run_stream(jobs.stream_uv_chunks(_events_stream(spark, sf)), "noop", "update", "stream_uvcount", checkpoint=ckpt)
    state = sinks.read_state(spark, ckpt)
    bits = state.schema["value"].dataType.fieldNames()[0]
    end = F.col(f"key.{state.schema['key'].dataType.fieldNames()[0]}.end")
    return state.groupBy(end.cast("timestamp_ntz").alias("window_end")).agg(
        F.sum(F.bitmap_count(F.col(f"value.{bits}"))).alias("uv"))


def text_scan(spark, sf):
    """Behaviour lines kept as text files, scanned and parsed."""
    path = scratch_path(spark, "text_scan")
    td.behavior_lines(spark, sf).select("value").write.text(path)
    return _clean(only(files.parse_user_behavior(files.read_lines(spark, path)), "behavior", "pv"))


def _pinned(q: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        use_utc(spark)
        return q(spark, sf)
    run.__name__ = q.__name__
    run.__doc__ = q.__doc__
    return run


_QUERIES: dict[str, Query] = {
    "parse_ad_click": parse_ad_click,
    "parse_login": parse_login,
    "parse_order": parse_order,
    "parse_receipt": parse_receipt,
    "channel_sliding_dense": channel_sliding_dense,
    "sequence_3step": sequence_3step,
    "parse_behavior": parse_behavior,
    "access_log_parse": access_log_parse,
    "static_filter": static_filter,
    "channel_exclude": channel_exclude,
    "hot_items_topn": hot_items_topn,
    "hot_items_sql": hot_items_sql,
    "ranking_report": ranking_report,
    "topn_changelog": topn_changelog,
    "pv_hourly": pv_hourly,
    "pv_salted": pv_salted,
    "uv_exact": uv_exact,
    "uv_bitmap": uv_bitmap,
    "uv_running": uv_running,
    "hot_pages_topn": hot_pages_topn,
    "late_classify": late_classify,
    "late_rows": late_rows,
    "lateness_counts": lateness_counts,
    "channel_sliding": channel_sliding,
    "ad_passed": ad_passed,
    "ad_warnings": ad_warnings,
    "ad_province": ad_province,
    "login_bursts": login_bursts,
    "login_pairs": login_pairs,
    "login_pattern": login_pattern,
    "order_paid": order_paid,
    "order_timeouts": order_timeouts,
    "order_status": order_status,
    "tx_interval_join": tx_interval_join,
    "tx_outer_join": tx_outer_join,
    "tx_matched": tx_matched,
    "tx_unmatched": tx_unmatched,
    "stream_hot_items": stream_hot_items,
    "stream_uv": stream_uv,
    "stream_tx_join": stream_tx_join,
    "stream_tx_outer": stream_tx_outer,
    "stream_changelog": stream_changelog,
    "stream_login_pairs": stream_login_pairs,
    "stream_order_paid": stream_order_paid,
    "stream_ad_passed": stream_ad_passed,
    "stream_order_status": stream_order_status,
    "stream_login_bursts": stream_login_bursts,
    "stream_tx_matched": stream_tx_matched,
    "stream_tx_unmatched": stream_tx_unmatched,
    "stream_sequence_3step": stream_sequence_3step,
    "stream_late_rows": stream_late_rows,
    "stream_lateness_counts": stream_lateness_counts,
    "stream_hot_pages": stream_hot_pages,
    "stream_uv_running": stream_uv_running,
    "stream_uvcount": stream_uvcount,
    "text_scan": text_scan,
}

QUERIES: dict[str, Query] = {k: _pinned(v) for k, v in _QUERIES.items()}
