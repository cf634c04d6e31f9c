"""Line parsers (O-08..O-13), Kafka option building (O-02/O-03), stream changelog (O-06)."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.operators.topn import changelog
from eventide.sources import files, kafka


def _lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_user_behavior(spark):
    out = files.parse_user_behavior(_lines(spark, "543462,1715,1464116,pv,1511658000", "1,x,2,pv,3")).collect()
    assert (out[0].user_id, out[0].item_id, out[0].category_id, out[0].behavior) == (543462, 1715, 1464116, "pv")
    assert out[0].ts == dt.datetime(2017, 11, 26, 1, 0, 0)
    assert not out[0]._corrupt and out[1]._corrupt


def test_parse_ad_login_order_receipt(spark):
    ad = files.parse_ad_click(_lines(spark, "543462,1715,beijing,beijing,1511658000")).first()
    assert (ad.province, ad.city, ad.ad_id) == ("beijing", "beijing", 1715)
    lg = files.parse_login(_lines(spark, "5402,83.149.11.115,success,1558430815")).first()
    assert (lg.user_id, lg.ip, lg.event_type) == (5402, "83.149.11.115", "success")
    od = files.parse_order(_lines(spark, "34729,create,,1558430842", "34729,pay,sd76f87d6,1558430844")).collect()
    assert od[0].tx_id == "" and od[1].tx_id == "sd76f87d6" and not od[0]._corrupt
    rc = files.parse_receipt(_lines(spark, "ewr342as4,wechat,1558430845")).first()
    assert (rc.tx_id, rc.pay_channel, rc.ts) == ("ewr342as4", "wechat", dt.datetime(2019, 5, 21, 9, 27, 25))


def test_parse_keeps_extra_columns(spark):
    lines = spark.createDataFrame([("1,2,3,pv,4", 7)], "value string, seq bigint")
    assert files.parse_user_behavior(lines, keep=("seq",)).first().seq == 7


def test_read_lines(spark, tmp_path):
    p = tmp_path / "log.csv"
    p.write_text("1,2,3,pv,4\n5,6,7,pv,8")
    assert files.parse_user_behavior(files.read_lines(spark, str(p))).count() == 2


def test_kafka_options():
    o = kafka.kafka_options("localhost:9092", "hot_items", group_id="group-topn")
    assert o == {"kafka.bootstrap.servers": "localhost:9092", "subscribe": "hot_items",
                 "startingOffsets": "latest", "kafka.group.id": "group-topn"}


def test_changelog_multiset(spark):
    prev = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    curr = spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string")
    got = sorted((r.k, r.v, r.op) for r in changelog(prev, curr).collect())
    assert got == [(1, "a", "-"), (2, "b", "-"), (3, "c", "+")]


def test_changelog_stream_sink(spark, tmp_path):
    from eventide.streaming.sinks import changelog_batch
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    w = changelog_batch(state, lambda acc: acc.groupBy("k").agg(F.count(F.lit(1)).alias("n")), out)
    b0 = spark.createDataFrame([(1,), (2,)], "k int")
    b1 = spark.createDataFrame([(1,)], "k int")
    w(b0, 0)
    w(b1, 1)
    w(b1, 1)          # a retried batch rewrites the same output
    rows = sorted((r.batch, r.k, r.n, r.op) for r in spark.read.parquet(out).collect())
    assert rows == [(0, 1, 1, "+"), (0, 2, 1, "+"), (1, 1, 1, "-"), (1, 1, 2, "+")]


def test_upsert_sink_latest_wins(spark, tmp_path):
    from eventide.streaming.sinks import read_upserted, upsert_batch
    path = str(tmp_path / "up")
    w = upsert_batch(path, ["k"])
    w(spark.createDataFrame([(1, 10), (2, 20)], "k int, v int"), 0)
    w(spark.createDataFrame([(1, 11), (3, 30)], "k int, v int"), 1)
    w(spark.createDataFrame([(1, 11), (3, 30)], "k int, v int"), 1)     # retried batch
    assert sorted(tuple(r) for r in read_upserted(spark, path).select("k", "v").collect()) == \
        [(1, 11), (2, 20), (3, 30)]
