"""Boundary instants and edge cases of the contracts."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.functions.text import drop_static_assets
from eventide.operators import late, patterns, reconcile, topn, windows
from eventide.sources import files

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
S = dt.timedelta(seconds=1)


def _t(secs):
    return T0 + dt.timedelta(seconds=secs)


def _logins(spark, rows):
    data = [(u, "1.1.1.1", t, _t(s), i) for i, (u, t, s) in enumerate(rows)]
    return spark.createDataFrame(data, "user_id bigint, ip string, event_type string, ts timestamp_ntz, seq bigint")


def test_gap_exactly_two_seconds(spark):
    lg = _logins(spark, [(1, "fail", 0), (1, "fail", 2)])
    assert patterns.failure_pairs(lg, 2 * S, inclusive=True).count() == 1
    assert patterns.failure_pattern(lg, 2 * S, inclusive=False).count() == 0


def test_success_at_anchor_plus_window_discards_burst(spark):
    lg = _logins(spark, [(1, "fail", 0), (1, "fail", 1), (1, "success", 2)])
    assert patterns.failure_bursts(lg, 2, 2 * S).count() == 0
    lg2 = _logins(spark, [(1, "fail", 0), (1, "fail", 1), (1, "success", 3)])
    assert patterns.failure_bursts(lg2, 2, 2 * S).count() == 1


def test_failure_at_anchor_plus_window_joins_burst(spark):
    lg = _logins(spark, [(1, "fail", 0), (1, "fail", 2), (1, "fail", 3), (1, "fail", 4)])
    got = sorted(r.fail_times for r in patterns.failure_bursts(lg, 2, 2 * S).collect())
    # anchor 0 takes 0 and 2; 3 anchors anew and takes 3, 4
    assert got == [2, 2]


def _orders(spark, rows):
    data = [(o, t, "" if t == "create" else f"tx{o}", _t(s), i) for i, (o, t, s) in enumerate(rows)]
    return spark.createDataFrame(data, "order_id bigint, event_type string, tx_id string, ts timestamp_ntz, seq bigint")


def test_pay_exactly_at_timeout(spark):
    od = _orders(spark, [(1, "create", 0), (1, "pay", 900), (2, "create", 0), (2, "pay", 899)])
    st = {r.order_id: r.status for r in patterns.order_status(od, 900 * S).collect()}
    assert st == {1: "paid_after_timeout", 2: "paid"}
    fn = {r.order_id: r.tag for r in patterns.order_funnel(od, 900 * S).collect()}
    assert fn == {1: "TIMEOUT", 2: "PAY"}


def test_pay_and_create_same_instant(spark):
    od = _orders(spark, [(1, "pay", 5), (1, "create", 5)])
    assert [r.status for r in patterns.order_status(od, 900 * S).collect()] == ["paid"]


def test_one_pay_serves_several_creates_in_funnel(spark):
    od = _orders(spark, [(1, "create", 0), (1, "create", 10), (1, "pay", 20)])
    assert patterns.order_funnel(od, 900 * S).filter(F.col("tag") == "PAY").count() == 2
    st = sorted(r.status for r in patterns.order_status(od, 900 * S).collect())
    assert st == ["created_timeout", "paid"]


def _tx(spark, pays, recs):
    p = spark.createDataFrame([(tx, i, _t(s), i) for i, (tx, s) in enumerate(pays)],
                              "tx_id string, order_id bigint, ts timestamp_ntz, seq bigint")
    r = spark.createDataFrame([(tx, "wechat", _t(s), 100 + i) for i, (tx, s) in enumerate(recs)],
                              "tx_id string, pay_channel string, ts timestamp_ntz, seq bigint")
    return p, r


def test_interval_bounds_inclusive(spark):
    p, r = _tx(spark, [("a", 10), ("b", 10), ("c", 10), ("d", 10)],
               [("a", 15), ("b", 7), ("c", 16), ("d", 6)])
    out = reconcile.interval_join(p.withColumnRenamed("ts", "pay_ts").drop("seq"),
                                  r.withColumnRenamed("ts", "receipt_ts").drop("seq"),
                                  ["tx_id"], -3 * S, 5 * S, lts="pay_ts", rts="receipt_ts")
    assert sorted(x.tx_id for x in out.collect()) == ["a", "b"]


def test_reconcile_patience_and_overwrite(spark):
    p, r = _tx(spark, [("a", 10), ("b", 10), ("c", 10), ("c", 11)],
               [("a", 15), ("b", 16), ("c", 12)])
    out = reconcile.reconcile(p, r, "tx_id", 5 * S, 3 * S, ["order_id", "ts"], ["pay_channel", "ts"])
    m = sorted((x.tx_id, x.left.order_id) for x in out.filter(F.col("tag") == "MATCH").collect())
    # a: receipt exactly at +5s matches; b: +6s does not; c: second pay overwrites first
    assert m == [("a", 0), ("c", 3)]
    un = sorted((x.tx_id, x.left is not None) for x in out.filter(F.col("tag") == "UNMATCHED").collect())
    assert un == [("b", False), ("b", True), ("c", True)]


def test_window_edge_and_top_n_ties(spark):
    df = spark.createDataFrame([(1, _t(0)), (2, _t(0)), (3, _t(3600))], "item_id bigint, ts timestamp_ntz")
    c = windows.tumbling_count(df, ["item_id"], dt.timedelta(hours=1))
    ends = sorted((r.item_id, r.window_end) for r in c.collect())
    assert ends == [(1, _t(3600)), (2, _t(3600)), (3, _t(7200))]
    top = topn.topn_per_window(c, 1, "item_id").collect()
    assert sorted((r.item_id, r.rank) for r in top) == [(1, 1), (3, 1)]


def test_late_row_with_some_windows_expired(spark):
    rows = [(0, _t(100), 0), (1, _t(920), 1), (2, _t(590), 2)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, seq bigint")
    out = late.late_classify(df, 0 * S, 60 * S, 600 * S, 300 * S, seq="seq")
    st = {(r.event_id, r.window_end): r.status for r in out.collect()}
    # wm before row 2 = 920s; window ending 600s: 599.999999 + 60 <= 920 -> expired;
    # window ending 900s: last instant 899.999999 <= 920 < 959.999999 -> late update
    assert st[(2, _t(600))] == "expired"
    assert st[(2, _t(900))] == "late_update"
    assert late.late_rows(df, 0 * S, 60 * S, 600 * S, 300 * S, seq="seq").count() == 0


def test_static_assets_and_malformed_line(spark):
    lines = spark.createDataFrame([("1.1.1.1 7 - 01/01/2024:00:00:00 +0000 GET /a.js?v=1",),
                                   ("1.1.1.1 7 - 01/01/2024:00:00:01 +0000 GET /a.js",),
                                   ("garbage",)], "value string")
    parsed = files.parse_access_log(lines)
    assert parsed.filter("_corrupt").count() == 1
    kept = drop_static_assets(parsed.filter(~F.col("_corrupt")), "url").collect()
    assert [r.url for r in kept] == ["/a.js?v=1"]


def test_access_log_zone(spark):
    lines = spark.createDataFrame([("1.1.1.1 7 - 01/01/2024:08:00:00 +0800 GET /a",)], "value string")
    assert files.parse_access_log(lines).first().ts == _t(8 * 3600)
    assert files.parse_access_log(lines, honour_zone=True).first().ts == _t(0)


def test_outer_interval_join_equals_brute_force(spark):
    p, r = _tx(spark, [("a", 10), ("a", 30), ("b", 10), ("c", 50)],
               [("a", 12), ("a", 9), ("b", 40), ("d", 1)])
    lp = p.withColumnRenamed("ts", "pay_ts").withColumnRenamed("seq", "pseq")
    rr = r.withColumnRenamed("ts", "receipt_ts").withColumnRenamed("seq", "rseq")
    gap = F.unix_timestamp(F.col("receipt_ts").cast("timestamp")) - F.unix_timestamp(F.col("pay_ts").cast("timestamp"))
    brute = lp.join(rr.withColumnRenamed("tx_id", "rtx"),
                    (F.col("tx_id") == F.col("rtx")) & gap.between(-3, 5), "full")
    brute = brute.select(F.coalesce("tx_id", "rtx").alias("tx_id"), "order_id", "pay_ts", "pseq",
                         "pay_channel", "receipt_ts", "rseq")
    got = reconcile.interval_join(lp, rr, ["tx_id"], -3 * S, 5 * S, how="full",
                                  lts="pay_ts", rts="receipt_ts")
    cols = ["tx_id", "order_id", "pay_ts", "pseq", "pay_channel", "receipt_ts", "rseq"]
    assert sorted(got.select(*cols).collect(), key=str) == sorted(brute.select(*cols).collect(), key=str)
    left = reconcile.interval_join(lp, rr, ["tx_id"], -3 * S, 5 * S, how="left", lts="pay_ts", rts="receipt_ts")
    # a@10 matches receipts at 9 and 12; a@30, b@10, c@50 have none
    assert left.count() == 5 and left.filter(F.col("rseq").isNull()).count() == 3


def test_operators_independent_of_session_zone(spark):
    """Events across a US DST change give the same results under a DST session clock
    (zone-free micros fallback) as under UTC (cast fast path)."""
    base = dt.datetime(2024, 3, 10, 9, 30)        # 01:30 in Los Angeles, DST starts at 02:00
    rows = [(1, "1.1.1.1", t, base + dt.timedelta(minutes=m), i)
            for i, (t, m) in enumerate([("fail", 0), ("fail", 50), ("fail", 70), ("success", 200)])]
    schema = "user_id bigint, ip string, event_type string, ts timestamp_ntz, seq bigint"
    old = spark.conf.get("spark.sql.session.timeZone")
    results = []
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            lg = spark.createDataFrame(rows, schema)
            pairs = sorted((r.first_fail_ts, r.last_fail_ts) for r in
                           patterns.failure_pairs(lg, dt.timedelta(minutes=60)).collect())
            wins = sorted((r.window_end, r.cnt) for r in
                          windows.tumbling_count(lg, [], dt.timedelta(hours=1)).collect())
            results.append((pairs, wins))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert results[0] == results[1]
    assert results[0][0] == [(base, base + dt.timedelta(minutes=50)),
                             (base + dt.timedelta(minutes=50), base + dt.timedelta(minutes=70))]
