"""Small hand-made logs with known answers, through the line parsers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.operators import caps, patterns, reconcile, windows
from eventide.sources import files

S = dt.timedelta(seconds=1)
T0 = 1_600_000_000


def _lines(spark, rows):
    return spark.createDataFrame([(i, ",".join(map(str, r))) for i, r in enumerate(rows)],
                                 "seq bigint, value string").select("value", "seq")


def _secs(x):
    return int(x.replace(tzinfo=dt.timezone.utc).timestamp()) - T0


#: user 7 fails three times in a row and once more later; user 8's failures are split by a
#: success; user 9's success arrives out of order in the file.
LOGINS = [(7, "10.0.0.7", "fail", T0), (8, "10.0.0.8", "fail", T0 + 1), (7, "10.0.0.7", "fail", T0 + 1),
          (8, "10.0.0.8", "success", T0 + 2), (7, "10.0.0.7", "fail", T0 + 2), (8, "10.0.0.8", "fail", T0 + 2),
          (9, "10.0.0.9", "fail", T0 + 10), (9, "10.0.0.9", "fail", T0 + 12), (9, "10.0.0.9", "success", T0 + 11),
          (7, "10.0.0.7", "fail", T0 + 60), (7, "10.0.0.7", "fail", T0 + 62)]


@pytest.fixture
def logins(spark):
    return files.parse_login(_lines(spark, LOGINS), keep=("seq",)).drop("_corrupt")


def test_failure_pairs(logins):
    out = patterns.failure_pairs(logins, 2 * S, inclusive=True)
    got = sorted((r.user_id, _secs(r.first_fail_ts), _secs(r.last_fail_ts)) for r in out.collect())
    assert got == [(7, 0, 1), (7, 1, 2), (7, 60, 62)]
    assert out.first().warn_msg.endswith("login fail 2 times in 2 seconds.")


def test_strict_pattern(logins):
    out = patterns.failure_pattern(logins, 2 * S, inclusive=False)
    assert sorted(_secs(r.first_fail_ts) for r in out.collect()) == [0, 1]
    assert out.orderBy("first_fail_ts").first().warn_msg == f"login fail LoginEvent(7,10.0.0.7,fail,{T0})"


def test_failure_bursts(logins):
    out = patterns.failure_bursts(logins, 2, 2 * S)
    got = sorted((r.user_id, _secs(r.first_fail_ts), _secs(r.last_fail_ts), r.fail_times) for r in out.collect())
    assert got == [(7, 0, 2, 3), (7, 60, 62, 2)]
    assert out.filter(F.col("fail_times") == 3).first().warn_msg == "login fail in 2s for 3 times."


def test_one_cluster_of_50000_failures(spark):
    n = 50_000          # one a second: every 11 failures span the 10 seconds of a burst
    df = spark.range(n).select(F.lit(1).cast("bigint").alias("user_id"), F.lit("fail").alias("event_type"),
                               F.timestamp_add("SECOND", "id", F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
                               F.col("id").alias("seq"))
    out = patterns.failure_bursts(df, 2, 10 * S)
    want = n // 11 + (1 if n % 11 >= 2 else 0)
    assert out.count() == want and out.agg(F.max("fail_times")).first()[0] == 11


def test_sequence_of_three_steps(logins):
    is_fail = F.col("event_type") == "fail"
    steps = [patterns.Step("a", is_fail), patterns.Step("b", is_fail, "next"),
             patterns.Step("c", F.col("event_type") == "fail")]
    out = patterns.match_sequence(logins, ["user_id"], steps, 10 * S)
    got = sorted((r.user_id, _secs(r.a_ts), r.tag, r.steps) for r in out.collect())
    assert got == [(7, 0, "MATCH", 3), (7, 1, "TIMEOUT", 2), (7, 2, "TIMEOUT", 1), (7, 60, "TIMEOUT", 2),
                   (7, 62, "TIMEOUT", 1), (8, 1, "TIMEOUT", 1), (8, 2, "TIMEOUT", 1), (9, 10, "TIMEOUT", 1),
                   (9, 12, "TIMEOUT", 1)]


#: 1 paid, 2 paid too late, 3 never paid, 4 paid without a create, 5 paid in the very second it was made.
ORDERS = [(1, "create", "", T0), (2, "create", "", T0 + 5), (3, "create", "", T0 + 6), (1, "pay", "tx1", T0 + 600),
          (2, "pay", "tx2", T0 + 5 + 901), (4, "pay", "tx4", T0 + 50), (5, "pay", "tx5", T0 + 70),
          (5, "create", "", T0 + 70)]


@pytest.fixture
def orders(spark):
    return files.parse_order(_lines(spark, ORDERS), keep=("seq",)).drop("_corrupt")


def test_order_funnel(orders):
    out = patterns.order_funnel(orders, 900 * S)
    assert sorted((r.order_id, r.tag) for r in out.collect()) == [
        (1, "PAY"), (2, "TIMEOUT"), (3, "TIMEOUT"), (5, "PAY")]
    assert out.filter("order_id = 1").first().msg == (
        "order 1 start at 2020-09-13 12:26:40.0 and payed at 2020-09-13 12:36:40.0")


def test_order_status(orders):
    out = patterns.order_status(orders, 900 * S)
    assert sorted((r.order_id, r.status) for r in out.collect()) == [
        (1, "paid"), (2, "paid_after_timeout"), (3, "created_timeout"), (4, "pay_without_create"), (5, "paid")]
    assert out.filter("order_id = 4").first().msg == "[4] payed but not found create"


def test_one_order_with_200000_events_in_a_day(spark):
    """Linear in a hot key: the last row is the only pay, so every create looks ahead over all rows."""
    n = 200_000
    df = spark.range(n).select(
        F.lit(1).cast("bigint").alias("order_id"),
        F.when(F.col("id") == n - 1, F.lit("pay")).otherwise(F.lit("create")).alias("event_type"),
        F.timestamp_add("MILLISECOND", F.col("id") * 400, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
        F.col("id").alias("seq"))
    out = patterns.order_funnel(df, dt.timedelta(hours=24))
    assert out.filter("tag = 'PAY'").count() == n - 1


RECEIPTS = [("tx1", "alipay", T0 + 598), ("tx2", "wechat", T0 + 5 + 901 + 6), ("tx4", "alipay", T0 + 54),
            ("tx9", "wechat", T0 + 99)]


def _pays_receipts(spark, orders):
    return orders.filter(F.col("event_type") == "pay"), files.parse_receipt(
        _lines(spark, RECEIPTS), keep=("seq",)).drop("_corrupt")


def test_interval_join(spark, orders):
    pays, rec = _pays_receipts(spark, orders)
    out = reconcile.interval_join(pays.select("tx_id", "order_id", F.col("ts").alias("pay_ts")),
                                  rec.select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts")),
                                  ["tx_id"], -3 * S, 5 * S, lts="pay_ts", rts="receipt_ts")
    assert sorted(r.tx_id for r in out.collect()) == ["tx1", "tx4"]


def test_reconcile_with_any_column_types(spark, orders):
    pays, rec = _pays_receipts(spark, orders)
    pays = pays.select("tx_id", "order_id", "ts", "seq", F.lit(1).cast("decimal(10,2)").alias("amount"),
                       F.struct(F.lit(1).alias("x"), F.array(F.lit("y")).alias("z")).alias("nested"))
    out = reconcile.reconcile(pays, rec.select("tx_id", "pay_channel", "ts", "seq"), "tx_id", 5 * S, 3 * S,
                              ["order_id", "amount", "nested"], ["pay_channel", "ts"])
    rows = out.collect()
    assert sorted(r.tx_id for r in rows if r.tag == "MATCH") == ["tx1", "tx4"]
    assert sorted(r.tx_id for r in rows if r.tag != "MATCH" and r.left) == ["tx2", "tx5"]
    assert sorted(r.tx_id for r in rows if r.tag != "MATCH" and r.right) == ["tx2", "tx9"]


def test_click_cap(spark):
    clicks = [(u, 3, "p%d" % (i % 2), "c", T0 + i) for u, k in ((1, 12), (2, 10), (3, 1)) for i in range(k)]
    df = files.parse_ad_click(_lines(spark, clicks + [(1, 3, "p0", "c", "bad")]), keep=("seq",)).drop("_corrupt")
    ranked = caps.rate_cap(df, ["user_id", "ad_id"], 10, "Asia/Shanghai")
    assert caps.cap_passed(ranked, 10).count() == 21
    warns = caps.cap_warnings(ranked, ["user_id", "ad_id"], 10).collect()
    assert [(w.user_id, _secs(w.ts), w.msg) for w in warns] == [(1, 10, "Click Over 10 times today.")]


def test_rows_without_a_time_are_in_no_window(spark):
    df = files.parse_user_behavior(_lines(spark, [(1, 2, 3, "pv", T0), (1, 2, 3, "pv", "late")]), keep=("seq",))
    hour = dt.timedelta(hours=1)
    for out in (windows.tumbling_count(df, [], hour), windows.pv_salted(df, hour, salt_cols=["seq"]),
                windows.sliding_count_sparse(df, [], hour, dt.timedelta(minutes=30))):
        assert all(v is not None for r in out.collect() for v in r) and out.count()
