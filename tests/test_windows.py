"""Window operators against Spark's own window() on small inputs (brute force)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators import uniques, windows

T0 = dt.datetime(2024, 1, 1)


def _events(spark, n=300, seed=3):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(5), rnd.randrange(20), T0 + dt.timedelta(seconds=rnd.randrange(6 * 3600)), i)
            for i in range(n)]
    return spark.createDataFrame(rows, "item_id bigint, user_id bigint, ts timestamp_ntz, seq bigint")


def _naive(df, keys, size, slide):
    w = F.window("ts", f"{int(size.total_seconds())} seconds", f"{int(slide.total_seconds())} seconds")
    return df.groupBy(*keys, w.alias("w")).count().select(*keys, F.col("w.end").alias("window_end"),
                                                          F.col("count").alias("cnt"))


def test_sliding_count_equals_window(spark):
    df = _events(spark)
    size, slide = dt.timedelta(hours=1), dt.timedelta(minutes=5)
    a = windows.sliding_count(df, ["item_id"], size, slide).select("item_id", "window_end", "cnt")
    b = _naive(df, ["item_id"], size, slide)
    assert sorted(a.collect()) == sorted(b.collect())


def test_sparse_and_dense_equal_window(spark):
    df = _events(spark, n=80)
    size, slide = dt.timedelta(hours=2), dt.timedelta(minutes=10)
    dense = windows.sliding_count_dense(df, ["item_id"], size, slide, carry_width=dt.timedelta(minutes=30))
    b = _naive(df, ["item_id"], size, slide)
    assert sorted(dense.select("item_id", "window_end", "cnt").collect()) == sorted(b.collect())
    sp = windows.sliding_count_sparse(df, ["item_id"], size, slide)
    assert sp.agg(F.sum(F.col("n_windows") * F.col("cnt"))).first()[0] == 80 * 12


def test_pv_salted_and_uniques(spark):
    df = _events(spark)
    h = dt.timedelta(hours=1)
    assert sorted(windows.pv_salted(df, h).collect()) == sorted(windows.pv_per_window(df, h).collect())
    exact = sorted(uniques.uv_exact(df, h).collect())
    assert sorted(uniques.uv_bitmap(df, h).collect()) == exact
    run = uniques.uv_running(df, h, carry_width=dt.timedelta(minutes=7))
    last = run.groupBy("window_end").agg(F.max("uv").alias("uv"))
    assert sorted(last.collect()) == exact


def test_sliding_count_many_windows_per_row_uses_intervals(spark):
    df = _events(spark, n=150)
    size, slide = dt.timedelta(minutes=10), dt.timedelta(seconds=5)   # 120 windows per row
    a = windows.sliding_count(df, ["item_id"], size, slide).select("item_id", "window_end", "cnt")
    b = _naive(df, ["item_id"], size, slide)
    assert sorted(a.collect()) == sorted(b.collect())


def test_size_that_is_no_multiple_of_slide(spark):
    """Few and many windows per row, also before 1970 and with rows on window edges."""
    df = _events(spark, n=60).union(spark.createDataFrame(
        [(1, 1, dt.datetime(1970, 1, 1), 900), (1, 1, dt.datetime(1969, 12, 31, 23, 59, 50), 901),
         (1, 2, dt.datetime(1970, 1, 1, 0, 0, 7), 902), (2, 2, None, 903)],
        "item_id bigint, user_id bigint, ts timestamp_ntz, seq bigint"))
    for size, slide in [(dt.timedelta(seconds=100), dt.timedelta(seconds=7)),
                        (dt.timedelta(minutes=10, seconds=1), dt.timedelta(seconds=6))]:
        b = sorted(_naive(df, ["item_id"], size, slide).collect())
        for form in (windows.sliding_count, windows.sliding_count_dense):
            got = form(df, ["item_id"], size, slide).select("item_id", "window_end", "cnt")
            assert sorted(got.collect()) == b
