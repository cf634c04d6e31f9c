"""Rankings of runs of windows against rankings of the windows themselves."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventide.operators import late, runs, topn

T0 = dt.datetime(2024, 1, 1)
S = dt.timedelta(seconds=1)
US = 1_000_000


@pytest.mark.parametrize("seed", [1, 2])
def test_places_are_those_of_every_window(spark, seed):
    rnd, slide, width = random.Random(seed), 5 * US, 100 * US
    rows, counts = [], defaultdict(list)
    for key in [None, "", "ä", "z", *(f"k{i}" for i in range(20))]:
        at = 0
        while at < 400:                                 # runs of a key do not overlap
            lo = at + rnd.randrange(0, 8) * 5
            stop = (lo // 100 + 1) * 100 - 5            # nor cross a span
            hi = min(stop, lo + rnd.randrange(0, 12) * 5)
            cnt = rnd.randrange(1, 4)
            rows.append((lo // 100, lo * US, hi * US, key, cnt))
            for e in range(lo, hi + 1, 5):
                counts[e].append((-cnt, key is not None, key))
            at = hi + 5
    df = spark.createDataFrame(rows, "span long, from_us long, to_us long, key string, cnt long")
    best = runs.topn_of_runs(df, "key", 3, 5 * S, shards=3)
    got = sorted((r.window_end, r.rank, r.key, r.cnt) for r in runs.windows_of_runs(best, 5 * S).collect())
    epoch = dt.datetime(1970, 1, 1)
    want = sorted((epoch + dt.timedelta(seconds=e), i + 1, x[2], -x[0])
                  for e, xs in counts.items() for i, x in enumerate(sorted(xs)[:3]))
    assert got == want
    assert width == 20 * slide and runs.topn_of_runs(df.where("false"), "key", 3, 5 * S).count() == 0


@pytest.mark.parametrize("span", [7, 12, 60, None])
def test_lateness_at_any_span(spark, span):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "a", "b", None]), T0 + dt.timedelta(seconds=i // 2 + rnd.choice([0, 0, -9, -25, 4])))
            for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, key string, ts timestamp_ntz")
    args = (3 * S, 6 * S, 20 * S, 5 * S)
    each = late.late_classify(df, *args).where("status <> 'expired'")
    want = each.groupBy("key", "window_end").agg(F.count_if(F.col("status") == "on_time").alias("cnt_on_time"),
                                                 F.count(F.lit(1)).alias("cnt"))
    got = late.lateness_counts(df, ["key"], *args, span=None if span is None else span * S)
    cols = ["key", "window_end", "cnt_on_time", "cnt"]
    order = lambda d: sorted((tuple(r) for r in d.select(*cols).collect()), key=str)     # noqa: E731
    assert order(got) == order(want)
    best = runs.windows_of_runs(runs.topn_of_runs(late.lateness_runs(
        df.where("key is not null"), ["key"], *args, span=None if span is None else span * S), "key", 1, 5 * S), 5 * S)
    plain = topn.topn_per_window(late.lateness_counts(df.where("key is not null"), ["key"], *args), 1, "key")
    cols = ["key", "window_end", "cnt", "rank"]
    assert order(best) == order(plain)
