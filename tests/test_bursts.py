"""Bursts in one pass: the step functions against the plain machine, any bucket width, long chains."""

import datetime as dt
import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from eventide.operators import patterns
from eventide.operators.bursts import _Steps

T0 = dt.datetime(2024, 1, 1)
DDL = "user_id bigint, event_type string, ts timestamp_ntz, seq bigint"


def _leaving(events, anchor, w):
    """The anchor that the machine leaves with, begun with ``anchor``."""
    for fail, at, seq in events:
        if not fail:
            anchor = None
        elif anchor is None or at > anchor[0] + w:
            anchor = (at, seq)
    return anchor


@pytest.mark.parametrize("seed", range(6))
def test_steps_are_the_machine_for_every_entering_anchor(seed):
    rnd = random.Random(seed)
    for _ in range(200):
        w, start = rnd.randrange(1, 12), 100
        events = sorted((start + rnd.randrange(40), i) for i in range(rnd.randrange(1, 25)))
        events = [(rnd.random() < 0.9, at, seq) for at, seq in events]
        steps = _Steps(start, w)
        for fail, at, seq in events:
            steps.failure(at, seq) if fail else steps.other()
        bounds, leave, seqs = steps.result()
        assert bounds == sorted(set(bounds))
        for a in [None, *((x, -1) for x in range(start - 30, start))]:
            i = 0 if a is None else bisect_right(bounds, a[0] + w)
            got = a if i == len(bounds) else None if leave[i] is None else (leave[i], seqs[i])
            assert got == _leaving(events, a, w)


def _bursts(events, n, w):
    out, cur = [], None                             # cur: anchor, count, last
    for kind, at, _ in events:
        if kind == "fail" and cur and at <= cur[0] + w:
            cur = (cur[0], cur[1] + 1, at)
            continue
        if cur and cur[1] >= n and (kind == "fail" or at > cur[0] + w):
            out.append((cur[0], cur[2], cur[1]))
        cur = (at, 1, at) if kind == "fail" else None
    if cur and cur[1] >= n:
        out.append((cur[0], cur[2], cur[1]))
    return out


@pytest.mark.parametrize("width", [1, 3, 10, 1000])
def test_bursts_at_any_bucket_width(spark, width):
    rnd = random.Random(width)
    rows = [(rnd.choice([None, 1, 1, 1, 2]), rnd.choice(["fail"] * 6 + ["success", None]), rnd.randrange(300), i)
            for i in range(500)]
    df = spark.createDataFrame([(k, e, T0 + dt.timedelta(seconds=t), i) for k, e, t, i in rows], DDL)
    got = patterns.failure_bursts(df, 3, dt.timedelta(seconds=8), carry_width=dt.timedelta(seconds=width)).collect()
    want = [(k, *b) for k in (None, 1, 2) for b in _bursts(
        sorted(((e, t, i) for u, e, t, i in rows if u == k), key=lambda r: r[1:]), 3, 8)]
    sec = [(r.user_id, int((r.first_fail_ts - T0).total_seconds()), int((r.last_fail_ts - T0).total_seconds()),
            r.fail_times) for r in got]
    assert sorted(sec, key=str) == sorted(want, key=str)


def test_empty_input_and_rows_without_a_time(spark):
    df = spark.createDataFrame([(1, "fail", None, 1), (1, "fail", T0, 2), (1, "fail", T0, 3)], DDL)
    w = dt.timedelta(seconds=2)
    assert [r.fail_times for r in patterns.failure_bursts(df, 2, w).collect()] == [2]
    assert patterns.failure_bursts(df.where("false"), 2, w).collect() == []


def test_200000_failures_of_one_user(spark):
    n = 200_000         # evenly spaced: chains never meet, the dearest case
    df = spark.range(n).select(F.lit(1).cast("bigint").alias("user_id"), F.lit("fail").alias("event_type"),
                               F.timestamp_add("SECOND", "id", F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
                               F.col("id").alias("seq"))
    out = patterns.failure_bursts(df, 2, dt.timedelta(seconds=100))
    r = out.agg(F.count(F.lit(1)), F.min("fail_times"), F.max("fail_times"), F.sum("fail_times")).first()
    assert tuple(r) == (n // 101 + 1, n % 101, 101, n)


def test_no_job_while_the_query_is_built(spark):
    df = spark.createDataFrame([(1, "fail", T0, 1)], DDL)
    spark.sparkContext.setJobGroup("bursts-build", "")
    patterns.failure_bursts(df, 2, dt.timedelta(seconds=2))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("bursts-build")
