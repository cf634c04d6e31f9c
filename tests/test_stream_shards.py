"""Keyed state machines over shards of keys, and late-data counts: own rows, several micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.sources import testdata as td
from eventide.streaming import jobs, late, sinks
from eventide.streaming.event_time import with_event_time
from eventide.operators import patterns

H_US = 3_600_000_000
FAR = dt.datetime(2030, 1, 1)
BIG = 2 ** 60 + 1


def _at(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def _written(spark, path, *batches):
    """The micro-batches' rows, one file each, as a stream that reads one at a time."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, td.EVENTS_DDL).coalesce(1).write.parquet(f"{path}/part{i}")
    return td.events_stream(spark, f"{path}/*", 1)


def _event(i, h, user, kind, k=0):
    return (i, None if h is None else _at(h), user, kind, 0.0, '{"k": %d}' % k)


FLUSH = [(10 ** 12 + i, FAR, -1, t, 0.0, '{"k": 0}') for i, t in enumerate(("error", "click", "signup", "purchase"))]


def _run(spark, name, df, **kw):
    sinks.run_stream(df, "memory", "append", name=name, **kw)
    return spark.table(name)


def _groups(spark, tmp_path, name, job):
    """Groups of state for 3,000 keys with one row each, none of them due yet."""
    kinds = F.array(*[F.lit(t) for t in ("error", "click", "signup")])
    rows = spark.range(3000).select(
        F.col("id").alias("event_id"), F.lit(_at(1)).cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.explode(kinds).alias("event_type"), F.lit(0.0).alias("value"), F.lit('{"k": 0}').alias("props"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    ckpt = f"{tmp_path}/ckpt"
    _run(spark, name, job(td.events_stream(spark, f"{tmp_path}/in")), checkpoint=ckpt)
    return sinks.read_state(spark, ckpt, "due").count()


def _relief(e):
    rows = td.logins_from(with_event_time(e, "ts", "0 seconds"), keep=jobs.EV)
    steps = [patterns.Step("fail", F.col("event_type") == "fail"),
             patterns.Step("again", F.col("event_type") == "fail", "next"),
             patterns.Step("relief", F.col("event_type") == "success", "followedBy")]
    return jobs.stream_sequence(rows, "user_id", "user_id long", steps, 24 * H_US)


JOBS = {"sequence": _relief, "pairs": lambda e: jobs.stream_login_pairs(e, 6 * H_US),
        "funnel": lambda e: jobs.stream_order_funnel(e, 24 * H_US),
        "bursts": lambda e: jobs.stream_login_bursts(e, 2, 6 * H_US)}


@pytest.mark.parametrize("job", JOBS)
def test_groups_of_state_do_not_grow_with_the_keys(spark, tmp_path, job):
    assert 0 < _groups(spark, tmp_path, f"t_groups_{job}", JOBS[job]) < 3000


def test_groups_of_the_cap_do_not_grow_with_the_keys(spark, tmp_path):
    dims = f"{tmp_path}/dims"
    spark.createDataFrame([(1, 1, "S")], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(
        f"{dims}/customer.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{dims}/nation.parquet")
    assert 0 < _groups(spark, tmp_path, "t_groups_cap", lambda e: jobs.stream_ad_cap(spark, dims, e, 1)) < 3000


def test_pairs_over_micro_batches_with_null_and_large_keys(spark, tmp_path):
    """Keys that share a shard stay apart, a failure is remembered over micro-batches, rows without a time go."""
    users = [None, BIG, BIG + 1, *range(40)]
    first = [_event(i, 1, u, "error") for i, u in enumerate(users)] + [_event(900, None, 1, "error")]
    second = [_event(1000 + i, 3, u, "error" if i % 2 == 0 else "click") for i, u in enumerate(users)]
    third = [_event(2000 + i, 8, u, "error") for i, u in enumerate(users)]
    s = _run(spark, "t_shard_pairs", jobs.stream_login_pairs(_written(spark, f"{tmp_path}/in", first, second, third, FLUSH),
                                                            6 * H_US))
    got = sorted((str(r.user_id), r.first_fail_ts, r.last_fail_ts) for r in s.where("user_id is null or user_id >= 0").collect())
    want = [(str(u), a, b) for i, u in enumerate(users) if i % 2 == 0 for a, b in ((_at(1), _at(3)), (_at(3), _at(8)))]
    assert got == sorted(want)


def test_bursts_over_micro_batches(spark, tmp_path):
    """A burst that a later micro-batch adds to is closed once, by its deadline, without a row of its key."""
    a = [_event(i, 1, u, "error") for i, u in enumerate([None, BIG, 5])]
    b = [_event(10, 2, None, "error"), _event(11, 2, BIG, "error"), _event(12, 2, 5, "click"), _event(13, 30, 6, "error")]
    c = [_event(20, 31, 6, "click"), _event(21, None, 7, "error")]
    s = _run(spark, "t_shard_bursts", jobs.stream_login_bursts(_written(spark, f"{tmp_path}/in", a, b, c), 2, 6 * H_US))
    assert sorted((str(r.user_id), r.first_fail_ts, r.last_fail_ts, r.fail_times) for r in s.collect()) == \
        [(str(BIG), _at(1), _at(2), 2), ("None", _at(1), _at(2), 2)]


def test_lateness_rows_are_counted_before_the_state(spark, tmp_path):
    """Rows of the same windows reach the state as one row with their number."""
    minute = dt.timedelta(minutes=1)
    rows = [_event(i, 1, 1, "error") for i in range(300)] + [_event(300 + i, 1, 1, None) for i in range(50)] + FLUSH[:1]
    ev = _written(spark, f"{tmp_path}/in", rows).select("event_id", "ts", "event_type", F.col("event_id").alias("seq"))
    late.split_late(ev, f"{tmp_path}/out", 30 * minute, 30 * minute, 60 * minute, 10 * minute, tie="event_id",
                    name="t_counted", counts=["event_type"])
    acc = late.accepted_rows(spark, f"{tmp_path}/out", "event_type string, n long")
    kept = spark.read.schema(acc.drop("event_time").schema).option("recursiveFileLookup", "true").parquet(
        f"{tmp_path}/out/rows").where("not _marker")
    assert sorted((str(r.event_type), r.n) for r in kept.collect()) == [("None", 50), ("error", 1), ("error", 300)]
    out = _run(spark, "t_counted_out", late.stream_lateness_counts(acc, ["event_type"], 30 * minute, 10 * minute,
                                                                  "event_type string"))
    got = sorted((str(r.event_type), r.cnt_on_time, r.cnt, r.late_updates, r.version) for r in out.where(
        f"window_end_us < {1_800_000_000_000_000}").collect())
    assert got == [("None", 50, 50, 0, 1)] * 6 + [("error", 300, 300, 0, 1)] * 6
