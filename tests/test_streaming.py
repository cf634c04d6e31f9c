"""Stream = batch parity on the sf0.001 events (file source, availableNow).

Far-future flush events (one per event type, user -1) advance the watermark
past every row, so all windows close and all timers fire (contract C10).
Catalyst may push a job's type filter below the watermark, so each job needs
a flush event it keeps; results for user -1 / year 2030 are left out.
"""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from eventide.operators import uniques
from eventide.plans import catalog as C
from eventide.sources import testdata as td
from eventide.streaming import jobs, sinks
from eventide.streaming.event_time import with_event_time

SF = "/root/testdata/sf0.001"
H_US = 3_600_000_000


@pytest.fixture(scope="module")
def src(spark):
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    d = tempfile.mkdtemp(prefix="eventide-stream-")
    td.events(spark, SF).write.parquet(f"{d}/events/part0")
    types = ["view", "click", "purchase", "signup", "error"]
    flush = spark.createDataFrame([(10**12 + i, dt.datetime(2030, 1, 1), -1, t, 0.0, '{"k": 0}')
                                   for i, t in enumerate(types)], td.EVENTS_DDL)
    flush.write.parquet(f"{d}/events/part1")
    return f"{d}/events/*"


def _run(spark, name, df, mode="append"):
    sinks.run_stream(df, "memory", mode, name=name)
    out = spark.table(name)
    for key in ("user_id", "order_id"):
        if key in out.columns:
            out = out.filter(~F.col(key).eqNullSafe(-1))
    if "tx_id" in out.columns:
        out = out.filter(~F.col("tx_id").eqNullSafe("-1"))
    if "window_end" in out.columns:
        out = out.filter(F.year("window_end") < 2029)
    return out


def _same(a, b, cols):
    a, b = a.select(*cols), b.select(*cols)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_login_pairs(spark, src):
    s = _run(spark, "t_pairs", jobs.stream_login_pairs(td.events_stream(spark, src), 6 * H_US))
    assert _same(s, C.login_pairs(spark, SF), ["user_id", "first_fail_ts", "last_fail_ts", "warn_msg"])


def test_stream_login_bursts(spark, src):
    s = _run(spark, "t_bursts", jobs.stream_login_bursts(td.events_stream(spark, src), 2, 6 * H_US))
    assert _same(s, C.login_bursts(spark, SF),
                 ["user_id", "first_fail_ts", "last_fail_ts", "fail_times", "warn_msg"])


def test_stream_order_status(spark, src):
    s = sinks.net_rows(_run(spark, "t_status", jobs.stream_order_status(td.events_stream(spark, src), 24 * H_US)))
    assert _same(s, C.order_status(spark, SF), ["order_id", "status", "tag", "create_ts", "pay_ts", "msg"])


def test_stream_order_funnel(spark, src):
    s = _run(spark, "t_funnel", jobs.stream_order_funnel(td.events_stream(spark, src), 24 * H_US))
    assert _same(s.filter(F.col("tag") == "PAY"), C.order_paid(spark, SF), ["order_id", "create_ts", "pay_ts"])
    assert _same(s.filter(F.col("tag") == "TIMEOUT"), C.order_timeouts(spark, SF),
                 ["order_id", "create_ts", "timeout_ts"])


def test_stream_reconcile(spark, src):
    s = _run(spark, "t_rec", jobs.stream_reconcile(td.events_stream(spark, src), 5 * H_US, 3 * H_US))
    cols = ["tx_id", "order_id", "pay_ts", "pay_seq", "pay_channel", "receipt_ts", "receipt_seq"]
    assert _same(s.filter(F.col("tag") == "MATCH"), C.tx_matched(spark, SF), cols)
    assert _same(s.filter(F.col("tag") == "UNMATCHED"), C.tx_unmatched(spark, SF), cols)


def test_stream_ad_cap(spark, src):
    s = _run(spark, "t_cap", jobs.stream_ad_cap(spark, SF, td.events_stream(spark, src), C.AD_CAP))
    passed = s.filter(F.col("tag") == "PASS")
    assert _same(passed, C.ad_passed(spark, SF), ["user_id", "ad_id", "province", "city", "ts", "day"])
    warns = s.filter(F.col("tag") == "WARN")
    assert _same(warns, C.ad_warnings(spark, SF), ["user_id", "ad_id", "day", "ts", "msg"])


def test_stream_hot_item_counts_and_topn(spark, src):
    s = _run(spark, "t_hot", jobs.stream_hot_item_counts(td.events_stream(spark, src)))
    assert _same(s, C.hot_items_counts(spark, SF), ["item_id", "window_end", "cnt"])


def test_stream_uv(spark, src):
    s = _run(spark, "t_uv", jobs.stream_uv(td.events_stream(spark, src)))
    assert _same(s, C.uv_exact(spark, SF), ["window_end", "uv"])


def test_stream_tx_join(spark, src):
    s = _run(spark, "t_tx", jobs.stream_tx_join(td.events_stream(spark, src), -3 * 3600, 5 * 3600))
    assert _same(s, C.tx_interval_join(spark, SF), ["tx_id", "order_id", "pay_ts", "pay_channel", "receipt_ts"])


def test_topn_writer_and_upsert(spark, src, tmp_path):
    out = str(tmp_path / "topn")
    counts = jobs.stream_hot_item_counts(td.events_stream(spark, src))
    sinks.run_stream(counts, jobs.topn_batch_writer(out, 5, "item_id"), "append", name="t_topn_w")
    got = spark.read.parquet(out).select("item_id", "window_end", "cnt", "rank")
    assert _same(got, C.hot_items_topn(spark, SF), ["item_id", "window_end", "cnt", "rank"])
    # O-05: latest count per window upserted by key; a re-run of the batch is idempotent
    up = str(tmp_path / "uv")
    w = sinks.upsert_batch(up, ["window_end"])
    batch = uniques.uv_exact(td.user_behavior(spark, SF).filter("behavior = 'pv'"), dt.timedelta(hours=1))
    w(batch, 0)
    w(batch, 1)
    assert sorted(sinks.read_upserted(spark, up).collect()) == sorted(batch.collect())


def test_event_time_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1, 5),)], "ts timestamp_ntz")
    r = with_event_time(df).first()
    assert r.ts_us == 1704067201000005


def test_late_pay_takes_the_timeout_back(spark, tmp_path):
    """Create, its time-out, and a pay eight days later, each in a micro-batch of its own, on default arguments."""
    day = lambda d: dt.datetime(2024, 1, d)
    files = [[(0, day(1), 1, "signup"), (1, day(1), 2, "signup")], [(2, day(3), -1, "signup")],
             [(3, day(9), 1, "purchase")], [(4, day(20), -1, "signup")], [(5, day(21), 3, "purchase"), (6, day(22), -1, "signup")]]
    src = str(tmp_path / "src")
    for i, rows in enumerate(files):
        spark.createDataFrame([(*r, 0.0, '{"k": 0}') for r in rows], td.EVENTS_DDL).coalesce(1).write.parquet(f"{src}/part{i}")
    ev = td.events_stream(spark, f"{src}/*", 1)
    sinks.run_stream(jobs.stream_order_status(ev, 24 * H_US), "memory", "append", name="t_late_pay")
    out = spark.table("t_late_pay").where("order_id > 0")
    told = [(r.order_id, r.op, r.status) for r in out.collect()]
    assert told.index((1, "+", "created_timeout")) < told.index((1, "-", "created_timeout"))
    want = C.patterns.order_status(td.order_events_from(spark.read.parquet(f"{src}/*")), dt.timedelta(days=1))
    assert _same(sinks.net_rows(out), want.where("order_id > 0"), ["order_id", "status", "tag", "create_ts", "pay_ts", "msg"])


def test_told_create_is_forgotten_where_asked():
    from eventide.streaming.processors import OrderStatusMachine
    m = OrderStatusMachine(10, forget_us=5)
    st = m.initial()
    m.step((1,), st, type("R", (), dict(event_type="create", ts_us=100)))
    assert m.deadline(st) == 110 and m.expire((1,), st, 109) == []
    assert [o[1] for o in m.expire((1,), st, 110)] == ["created_timeout"] and m.deadline(st) == 115
    assert m.expire((1,), st, 115) == [] and st == m.initial()
    assert OrderStatusMachine(10).deadline({"last": "create", "last_ts": 1, "told": True}) is None


def _arrivals(spark, path, rows, cuts, flush):
    """``rows`` as files in arrival order, then one far-future row: a micro-batch each."""
    for i, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 10 ** 9])):
        rows.filter((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.parquet(f"{path}/part{i}")
    spark.createDataFrame([flush], rows.schema).coalesce(1).write.parquet(f"{path}/part9")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{path}/*")


@pytest.fixture(scope="module")
def split(spark, tmp_path_factory):
    """The classifying stream over the events in three micro-batches and a flush: the folder it wrote."""
    from eventide.streaming import late
    d = str(tmp_path_factory.mktemp("late"))
    e = td.events(spark, SF).select("event_id", "ts", "event_type", td.late_arrival_seq().alias("seq"))
    stream = _arrivals(spark, f"{d}/src", e, [400, 800], (10 ** 12, dt.datetime(2030, 1, 1), "view", 10 ** 12))
    p = C.LATE
    late.split_late(stream, f"{d}/out", p["bound"], p["allowed"], p["size"], p["slide"], seq="seq", tie="event_id")
    return f"{d}/out"


def test_stream_late_side_output(spark, split):
    """Late rows of a stream fed in arrival-ordered files equal the batch side output."""
    got = spark.read.parquet(f"{split}/late").select("event_id", "ts", "seq", "wm")
    assert len(spark.read.parquet(f"{split}/late").select("batch").distinct().collect()) == 3
    assert _same(got, C.late_rows(spark, SF), ["event_id", "ts", "seq", "wm"])


def test_stream_lateness_counts_fire_again_and_leave_the_state(spark, split, tmp_path):
    from eventide.functions.time import from_micros
    from eventide.streaming import late
    p, ckpt = C.LATE, str(tmp_path / "ckpt")
    rows = late.accepted_rows(spark, split, C.LATE_DDL, max_files=1)
    sinks.run_stream(late.stream_lateness_counts(rows, ["event_type"], p["allowed"], p["slide"], "event_type string"),
                     "memory", "append", name="t_lateness", checkpoint=ckpt)
    fired = spark.table("t_lateness").where(f"window_end_us < {1861920000_000000}")
    last = fired.groupBy("event_type", "window_end_us").agg(
        F.max_by(F.struct("cnt_on_time", "cnt", "late_updates"), "version").alias("c"), F.max("version").alias("v"),
        F.count("*").alias("n"))
    assert last.where("v <> n").count() == 0
    got = last.select("event_type", from_micros("window_end_us").alias("window_end"), "c.*")
    assert _same(got, C.lateness_counts(spark, SF), ["event_type", "window_end", "cnt_on_time", "cnt", "late_updates"])
    left = sinks.read_state(spark, ckpt, "windows").select("key.*", "user_map_key.*", "user_map_value.*")
    assert left.where("window_end < 1861920000000000").count() == 0


def test_lateness_machine_versions():
    """A window fires at its end, again on a late row, and is dropped after the lateness."""
    from eventide.streaming.late import LatenessCounts

    class Value:
        def __init__(self): self.v = None
        def exists(self): return self.v is not None
        def get(self): return self.v
        def update(self, v): self.v = v
        def clear(self): self.v = None

    class Map(dict):
        containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.pop
        def iterator(self): return iter(self.items())

    class Handle:
        timers: set = set()
        def getValueState(self, *a): return Value()
        def getMapState(self, *a): return Map()
        def registerTimer(self, ms): self.timers.add(ms)
        def deleteTimer(self, ms): self.timers.remove(ms)

    at = lambda wm_us: type("T", (), dict(getCurrentWatermarkInMs=lambda self: wm_us // 1000 - 1))()
    row = lambda lo, hi, on: type("R", (), dict(lo=lo, hi=hi, on_from=on, marker=False))
    m, s = LatenessCounts(["k"], 10_000, 30_000), 10_000
    m.init(Handle())
    assert list(m.handleInputRows(("a", 0), [row(s, 2 * s, s), row(s, s, s)], at(0))) == []
    assert Handle.timers == {9}
    assert [tuple(r) for r in m.handleExpiredTimer(("a", 0), at(s), None)] == [("a", s, 2, 2, 0, 1)]
    assert [tuple(r) for r in m.handleInputRows(("a", 0), [row(s, 2 * s, 2 * s)], at(s))] == [("a", s, 2, 3, 1, 2)]
    assert [tuple(r) for r in m.handleExpiredTimer(("a", 0), at(4 * s), None)] == [("a", 2 * s, 2, 2, 0, 1)]
    assert list(m.windows) == [(2 * s,)]
    assert list(m.handleExpiredTimer(("a", 0), at(5 * s), None)) == [] and not m.windows and not m.due.exists()


def test_stream_hot_pages_refined_topn(spark, tmp_path):
    """Pages arriving late over several micro-batches: the last rankings equal the batch, and the state ends."""
    from eventide.streaming import late
    p, d = C.HOT_PAGES, str(tmp_path)
    pages = C._page_requests(spark, SF).select("ip", "user_id", "ts", "method", "url", "seq", "event_id")
    stream = _arrivals(spark, f"{d}/src", pages, [400, 800],
                       ("9.9.9.9", "-1", dt.datetime(2030, 1, 1), "GET", "/flush", 10 ** 12, 10 ** 12))
    late.split_late(stream, f"{d}/out", p["bound"], p["allowed"], p["size"], p["slide"], seq="seq", tie="event_id")
    rows = late.accepted_rows(spark, f"{d}/out", C.PAGES_DDL, max_files=1)
    sinks.run_stream(late.stream_hot_pages(rows, "url", p["n"], p["allowed"], p["slide"], p["size"], shards=3),
                     "memory", "append", name="t_pages", checkpoint=f"{d}/ckpt")
    got = late.last_rankings(spark.table("t_pages"), "url", p["n"], p["slide"]).filter(F.year("window_end") < 2029)
    assert _same(got, C.hot_pages_topn(spark, SF), ["url", "window_end", "cnt", "rank"])
    left = sinks.read_state(spark, f"{d}/ckpt", "changes").select("user_map_key.*")
    assert left.where("page <> '/flush'").count() == 0


def test_stream_sequence_all_outcomes(spark, src):
    rows = td.logins_from(with_event_time(td.events_stream(spark, src), "ts", "0 seconds"), keep=jobs.EV)
    s = _run(spark, "t_seq", jobs.stream_sequence(rows, "user_id", "user_id long", C._relief_steps(), 24 * H_US))
    assert _same(s, C.sequence_3step(spark, SF), ["user_id", "tag", "steps", "first_ts", "second_ts", "relief_ts"])


def test_stream_sequence_of_a_hot_user_over_bucket_edges(spark, hot):
    from eventide.operators.patterns import Step, match_sequence
    fail, rest = F.col("event_type") == "fail", F.col("event_type") == "success"
    steps = [Step("a", fail), Step("b", rest), Step("c", rest, "next"), Step("d", fail)]
    rows = td.logins_from(with_event_time(_hot_stream(spark, hot), "ts", "0 seconds"), keep=jobs.EV)
    s = _run(spark, "t_hot_seq", jobs.stream_sequence(rows, "user_id", "user_id long", steps, 12 * H_US))
    want = match_sequence(td.logins(spark, hot), ["user_id"], steps, dt.timedelta(hours=12))
    assert _same(s, want, ["user_id", "tag", "steps", "a_ts", "b_ts", "c_ts", "d_ts"])


def test_stream_uv_updates_and_state_over_micro_batches(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    e = td.events(spark, SF)
    for i in range(3):
        e.where(F.col("event_id") % 3 == i).coalesce(1).write.parquet(f"{src}/part{i}")
    sinks.run_stream(jobs.stream_uv_chunks(td.events_stream(spark, f"{src}/*", 1)), sinks.latest_batches(out), "update",
                     name="t_uv_run", checkpoint=ckpt)
    want = C.uv_bitmap(spark, SF)
    assert _same(jobs.latest_uv(spark.read.parquet(out)), want, ["window_end", "uv"])
    state = sinks.read_state(spark, ckpt)
    bits = state.schema["value"].dataType.fieldNames()[0]
    window = state.schema["key"].dataType.fieldNames()[0]
    held = state.groupBy(F.col(f"key.{window}.end").cast("timestamp_ntz").alias("window_end")).agg(
        F.sum(F.bitmap_count(F.col(f"value.{bits}"))).alias("uv"))
    assert _same(held, want, ["window_end", "uv"])


def test_cap_that_the_clock_resets(spark, tmp_path):
    """A timer of the processing time clears the count, so the key's next row passes again."""
    import time
    src = str(tmp_path / "src")
    schema = "user_id long, ad_id long, ts_us long, seq long"
    os.makedirs(f"{src}/none")
    clicks = spark.readStream.schema(schema).parquet(f"{src}/*")
    q = sinks.run_stream(jobs.stream_ad_cap_by_clock(clicks, 1, every_ms=2000), "memory", "update", name="t_clock",
                         available_now=False)
    try:
        for i in range(2):
            spark.createDataFrame([(1, 7, 100 * i + j, j) for j in range(3)], schema).coalesce(1).write.parquet(f"{src}/p{i}")
            for _ in range(200):
                if spark.table("t_clock").count() >= 2 * (i + 1):
                    break
                time.sleep(0.2)
            time.sleep(5)
    finally:
        q.stop()
    got = [(r.tag, r.ts_us, r.msg) for r in spark.table("t_clock").orderBy("ts_us").collect()]
    warn = "Click Over 1 times today."
    assert got == [("PASS", 0, None), ("WARN", 1, warn), ("PASS", 100, None), ("WARN", 101, warn)]


def test_next_reset_is_the_local_midnight():
    from eventide.streaming.processors import ProcessingTimeCap
    noon = int(dt.datetime(2024, 1, 15, 4, tzinfo=dt.timezone.utc).timestamp() * 1000)      # 12:00 in Shanghai
    assert ProcessingTimeCap(1).reset_at(noon) == noon + 12 * 3600 * 1000
    assert ProcessingTimeCap(1, "UTC").reset_at(noon) == noon + 20 * 3600 * 1000
    assert ProcessingTimeCap(1, every_ms=5).reset_at(noon) == noon + 5


def test_bursts_of_a_null_user(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [(u, "fail", t(m), m) for u in (1, None) for m in range(3)]
    df = spark.createDataFrame(rows, "user_id long, event_type string, ts timestamp_ntz, seq long")
    got = C.patterns.failure_bursts(df, 2, dt.timedelta(hours=1)).collect()
    assert sorted((r.user_id is None, r.fail_times) for r in got) == [(False, 3), (True, 3)]


def test_cap_state_ends_with_the_local_day():
    from eventide.streaming.processors import RateCapMachine
    m = RateCapMachine(1)
    st = m.initial()
    noon = int(dt.datetime(2024, 1, 15, 4, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000     # 12:00 local
    row = type("R", (), dict(province="p", city="c", ts_us=noon, seq=1))
    assert [o[2] for _ in range(3) for o in m.step((1, 1), st, row)] == ["PASS", "WARN"]
    midnight = int(dt.datetime(2024, 1, 15, 16, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert m.deadline(st) == midnight
    m.expire((1, 1), st, midnight - 1)
    assert st["cnt"] == 3
    m.expire((1, 1), st, midnight)
    assert st == m.initial() and m.deadline(st) is None


@pytest.fixture(scope="module")
def hot(spark):
    """A table folder whose user 1 holds a third of the events, half an hour apart or at equal times, and a flush."""
    import random
    import shutil
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    rnd, types, d = random.Random(5), ["click", "error", "error", "signup", "purchase"], tempfile.mkdtemp(prefix="eventide-hot-")
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * rnd.randrange(28 * 48)),
             1 if i % 3 == 0 else rnd.randrange(2, 40), rnd.choice(types), 0.0, '{"k": %d}' % rnd.randrange(2))
            for i in range(3000)]
    spark.createDataFrame(rows, td.EVENTS_DDL).repartition(4).write.parquet(f"{d}/events.parquet")
    spark.createDataFrame([(10**12 + i, dt.datetime(2030, 1, 1), -1, t, 0.0, '{"k": 0}') for i, t in enumerate(types)],
                          td.EVENTS_DDL).write.parquet(f"{d}/flush")
    for name in ("customer", "nation"):
        shutil.copy(f"{SF}/{name}.parquet", d)
    return d


def _hot_stream(spark, hot):
    return td.events_stream(spark, "%s/{events.parquet,flush}" % hot)


def test_stream_pairs_of_a_hot_user_over_bucket_edges(spark, hot):
    s = _run(spark, "t_hot_pairs", jobs.stream_login_pairs(_hot_stream(spark, hot), 6 * H_US))
    assert _same(s, C.login_pairs(spark, hot), ["user_id", "first_fail_ts", "last_fail_ts", "warn_msg"])


def test_stream_funnel_of_a_hot_order_over_bucket_edges(spark, hot):
    s = _run(spark, "t_hot_funnel", jobs.stream_order_funnel(_hot_stream(spark, hot), 24 * H_US))
    assert _same(s.filter(F.col("tag") == "PAY"), C.order_paid(spark, hot), ["order_id", "create_ts", "pay_ts"])
    assert _same(s.filter(F.col("tag") == "TIMEOUT"), C.order_timeouts(spark, hot),
                 ["order_id", "create_ts", "timeout_ts"])


def test_stream_cap_of_a_hot_user(spark, hot):
    from eventide.operators.caps import cap_passed, cap_warnings, rate_cap
    s = _run(spark, "t_hot_cap", jobs.stream_ad_cap(spark, hot, _hot_stream(spark, hot), 3))
    ranked = rate_cap(td.ad_clicks(spark, hot), ["user_id", "ad_id"], 3)
    assert _same(s.filter(F.col("tag") == "PASS"), cap_passed(ranked, 3),
                 ["user_id", "ad_id", "province", "city", "ts", "day"])
    assert _same(s.filter(F.col("tag") == "WARN"), cap_warnings(ranked, ["user_id", "ad_id"], 3),
                 ["user_id", "ad_id", "day", "ts", "msg"])


def test_stream_groups_of_a_hot_key_are_buckets(spark, hot, monkeypatch):
    seen = []

    def grouped(df, keys, *rest):
        seen.append(df.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return df

    monkeypatch.setattr(jobs, "run_ordered", grouped)
    monkeypatch.setattr(jobs, "_us_to_ts", lambda df, cols: df)
    ev = td.events(spark, hot)
    jobs.stream_login_pairs(ev, 6 * H_US)
    jobs.stream_order_funnel(ev, 24 * H_US)
    jobs.stream_ad_cap(spark, hot, ev, 3)
    # of the hot user's 1,000 events in 28 days a week has about 250 (400 orders' events: 100; 100 clicks an ad: 25)
    assert seen[0] < 350 and seen[1] < 180 and seen[2] < 60


def test_cap_buffers_the_first_rows_of_a_day():
    from operator import itemgetter
    from eventide.streaming.processors import RateCapMachine
    rows = ((day, t, 0) for t in range(10_000, 0, -1) for day in ("2024-01-01", "2024-01-02"))
    kept = RateCapMachine(2).worth(rows, ["click_day", "ts_us", "seq"], itemgetter(1, 2))
    assert sorted(kept) == [(d, t, 0) for d in ("2024-01-01", "2024-01-02") for t in (1, 2, 3)]
