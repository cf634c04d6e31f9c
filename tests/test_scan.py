"""keyed_scan must equal plain per-key windows, whatever the bucket width."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators.scan import Running, keyed_scan


def _data(spark, n=400, keys=3, seed=7):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(keys), rnd.randrange(1000), i, rnd.randrange(-5, 6)) for i in range(n)]
    return spark.createDataFrame(rows, "k bigint, t bigint, seq bigint, v bigint")


def test_scan_matches_windows(spark):
    df = _data(spark)
    bucket = (F.col("t") - F.pmod("t", F.lit(37))) / 37
    sc = keyed_scan(df, ["k"], ["t", "seq"], bucket.cast("bigint"), prev=["v", "t"], next=["v"],
                    running=[Running("s", F.col("v"), "sum"),
                             Running("mx", F.col("v"), "max", "prefix", False),
                             Running("mn", F.col("v"), "min", "suffix", False)])
    w = Window.partitionBy("k").orderBy("t", "seq")
    ref = df.select("k", "t", "seq", "v",
                    F.lag("v").over(w).alias("prev_v"), F.lag("t").over(w).alias("prev_t"),
                    F.lead("v").over(w).alias("next_v"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mx"),
                    F.min("v").over(w.rowsBetween(1, Window.unboundedFollowing)).alias("mn"))
    cols = ["k", "t", "seq", "v", "prev_v", "prev_t", "next_v", "s", "mx", "mn"]
    a = sorted(tuple(r) for r in sc.select(*cols).collect())
    b = sorted(tuple(r) for r in ref.select(*cols).collect())
    assert a == b


def test_global_scan_without_key(spark):
    df = _data(spark, n=200)
    sc = keyed_scan(df, [], ["seq"], (F.col("seq") / 16).cast("bigint"),
                    running=[Running("mx", F.col("t"), "max", "prefix", False)])
    w = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    ref = df.select("seq", F.max("t").over(w).alias("mx"))
    assert sorted(tuple(r) for r in sc.select("seq", "mx").collect()) == \
        sorted(tuple(r) for r in ref.collect())


def test_bounded_prev_matches_lag_within_bound(spark):
    from eventide.operators.scan import bounded_prev
    df = _data(spark, n=500, keys=4, seed=11)
    w_bound = 25
    for width in (7, 25, 100):          # halo spanning several buckets, one, or a fraction
        sc = bounded_prev(df, ["k"], ["t", "seq"], F.col("t"), w_bound, ["v"], width)
        got = {(r.k, r.seq, r.prev_v) for r in
               sc.filter(F.col("prev_gap_us") <= w_bound).collect()}
        w = Window.partitionBy("k").orderBy("t", "seq")
        ref = df.select("k", "seq", F.lag("v").over(w).alias("pv"),
                        (F.col("t") - F.lag("t").over(w)).alias("gap"))
        want = {(r.k, r.seq, r.pv) for r in ref.filter(F.col("gap") <= w_bound).collect()}
        assert got == want
        assert sc.count() == df.count()


def test_bounded_next_min_matches_window_within_bound(spark):
    from eventide.operators.scan import bounded_next_min
    df = _data(spark, n=500, keys=4, seed=13)
    w_bound = 25
    nxt = F.when(F.col("v") > 0, F.struct(F.col("t").alias("t"), F.col("seq").alias("seq")))
    w = Window.partitionBy("k").orderBy("t", "seq").rowsBetween(1, Window.unboundedFollowing)
    ref = df.select("k", "t", "seq", F.min(nxt).over(w).alias("nx"))
    want = {(r.k, r.seq, r.nx.t, r.nx.seq) for r in ref.collect()
            if r.nx is not None and r.nx.t - r.t < w_bound}
    for width in (7, 25, 100):
        sc = bounded_next_min(df, ["k"], ["t", "seq"], F.col("t"), w_bound, "nx", nxt, width)
        got = {(r.k, r.seq, r.nx.t, r.nx.seq) for r in sc.collect()
               if r.nx is not None and r.nx.t - r.t < w_bound}
        assert got == want
        assert sc.count() == df.count()
