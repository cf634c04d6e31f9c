"""The bundled test tables re-read as the reference's event records.

The reference's jobs read user-behaviour, access-log, ad-click, login, order
and receipt files.  The test data has one event table (``events``: event_id,
ts, user_id, event_type, value, props ``{"k": n}``) and TPC-H style dimension
tables.  Each function here derives one record type from them with column
expressions only (plus one join for the ad-click province), so every query's
work grows with the tables.  ``seq`` is the arrival order (``event_id``).

Mapping (also used verbatim by the DuckDB oracle):

* user behaviour: ``item_id = k``, ``category_id = k % 10``, behaviour =
  event type with ``view`` read as ``pv``.
* access log: a log line per event, ``/p/<k>`` with suffix ``.css`` when
  ``k % 5 = 0``, ``.js?v=1`` when ``k % 5 = 1``, else ``.html``; method
  ``POST`` for purchases, else ``GET``; then parsed back (O-13).
* ad click: click events; ``ad_id = k % 3``; province = nation name of the
  customer ``c_custkey = user_id``, city = its market segment.
* market: channel ``appstore, weibo, wechat, tieba`` by ``k % 4``; behaviour
  view->view, click->click, purchase->download, signup->install,
  error->uninstall.
* login: ``error`` is a failed login, any other event a success.
* order: ``signup`` creates, ``purchase`` pays; the order key is the user.
* receipt: ``view`` events are receipts of the user's transaction; channel
  ``wechat``/``alipay`` by ``k % 2``.
* late-data arrival order: ``seq = event_id + (event_id * 17) % 40``, ties
  by ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import micros

# ---- fixed values of the mapping ------------------------------------------
CHANNELS = ["appstore", "weibo", "wechat", "tieba"]
PAY_CHANNELS = ["wechat", "alipay"]
MARKET_BEHAVIOR = {"view": "view", "click": "click", "purchase": "download",
                   "signup": "install", "error": "uninstall"}
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a stream: parquet files arriving in folder ``path``."""
    r = spark.readStream.schema(EVENTS_DDL)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def user_behavior(spark: SparkSession, sf_dir: str, behaviors: list[str] | None = None) -> DataFrame:
    """user_id, item_id, category_id, behavior, ts, seq.

    ``behaviors`` keeps only those behaviours, stated on the raw event type
    (``pv`` is ``view``) so the predicate reaches the parquet scan.
    """
    e = events(spark, sf_dir)
    if behaviors:
        raw = [t for b in behaviors for t in (["view", "pv"] if b == "pv" else [b])]
        e = e.filter(F.col("event_type").isin(*raw))
    return user_behavior_from(e)


def user_behavior_from(e: DataFrame, keep: tuple = ()) -> DataFrame:
    return e.select(
        "user_id",
        _k().alias("item_id"),
        (_k() % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        "ts",
        F.col("event_id").alias("seq"),
        *keep,
    )


def behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User behaviour rendered as the reference's CSV lines (seconds precision)."""
    b = user_behavior(spark, sf_dir)
    secs = F.floor(micros("ts") / F.lit(1_000_000)).cast("bigint")
    return b.select(F.concat_ws(",", "user_id", "item_id", "category_id", "behavior",
                                secs.cast("string")).alias("value"), "seq")


def csv_lines(df: DataFrame, *cols: str) -> DataFrame:
    """Rows rendered as the reference's CSV lines: ``cols`` and the time in seconds; null fields are empty."""
    secs = F.floor(micros("ts") / F.lit(1_000_000)).cast("bigint")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return df.select(F.concat_ws(",", *fields, secs.cast("string")).alias("value"), "seq")


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One access-log line per event: ``ip user - time zone method url``."""
    return access_log_lines_from(events(spark, sf_dir))


def access_log_lines_from(e: DataFrame) -> DataFrame:
    k = _k()
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"),
                     (F.col("user_id") / 256).cast("bigint") % 256,
                     F.col("user_id") % 256)
    suffix = (F.when(k % 5 == 0, F.lit(".css"))
              .when(k % 5 == 1, F.lit(".js?v=1"))
              .otherwise(F.lit(".html")))
    url = F.concat(F.lit("/p/"), k.cast("string"), suffix)
    method = F.when(F.col("event_type") == "purchase", F.lit("POST")).otherwise(F.lit("GET"))
    line = F.concat_ws(" ", ip, F.col("user_id").cast("string"), F.lit("-"),
                       F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), method, url)
    return e.select(line.alias("value"), F.col("event_id").alias("event_id"),
                    late_arrival_seq().alias("seq"))


def late_arrival_seq() -> F.Column:
    """Shuffled arrival order used to exercise late data (ties broken by event_id)."""
    return F.col("event_id") + (F.col("event_id") * 17) % 40


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, ad_id, province, city, ts, seq (click events only)."""
    return ad_clicks_from(spark, sf_dir, events(spark, sf_dir))


def ad_clicks_from(spark: SparkSession, sf_dir: str, e: DataFrame, keep: tuple = ()) -> DataFrame:
    e = e.filter(F.col("event_type") == "click")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation has a fixed 25 rows in every scale: a proven broadcast bound.
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    # a click of an unknown user stays, with a null province
    return (e.join(cust, e.user_id == cust.c_custkey, "left")
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
             .select("user_id", (_k() % 3).alias("ad_id"), F.col("n_name").alias("province"),
                     F.col("c_mktsegment").alias("city"), "ts", F.col("event_id").alias("seq"),
                     *keep))


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id (string), behavior, channel, ts, seq."""
    e = events(spark, sf_dir)
    beh = F.col("event_type")
    mapped = None
    for src, dst in MARKET_BEHAVIOR.items():
        mapped = (F.when(beh == src, F.lit(dst)) if mapped is None
                  else mapped.when(beh == src, F.lit(dst)))
    mapped = mapped.otherwise(beh)
    chan = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (_k() % 4 + 1).cast("int"))
    return e.select(F.col("user_id").cast("string").alias("user_id"), mapped.alias("behavior"),
                    chan.alias("channel"), "ts", F.col("event_id").alias("seq"))


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, ip, event_type (fail/success), ts, seq."""
    return logins_from(events(spark, sf_dir))


def logins_from(e: DataFrame, keep: tuple = ()) -> DataFrame:
    ip = F.concat_ws(".", F.lit("10"), F.lit("1"), (_k() % 256).cast("string"),
                     (F.col("user_id") % 256).cast("string"))
    return e.select("user_id", ip.alias("ip"),
                    F.when(F.col("event_type") == "error", F.lit("fail"))
                    .otherwise(F.lit("success")).alias("event_type"),
                    "ts", F.col("event_id").alias("seq"), *keep)


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, event_type (create/pay), tx_id, ts, seq."""
    return order_events_from(events(spark, sf_dir))


def order_events_from(e: DataFrame, keep: tuple = ()) -> DataFrame:
    e = e.filter(F.col("event_type").isin("signup", "purchase"))
    is_pay = F.col("event_type") == "purchase"
    return e.select(F.col("user_id").alias("order_id"),
                    F.when(is_pay, F.lit("pay")).otherwise(F.lit("create")).alias("event_type"),
                    F.when(is_pay, F.col("user_id").cast("string")).otherwise(F.lit("")).alias("tx_id"),
                    "ts", F.col("event_id").alias("seq"), *keep)


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tx_id, pay_channel, ts, seq (view events)."""
    return receipts_from(events(spark, sf_dir))


def receipts_from(e: DataFrame, keep: tuple = ()) -> DataFrame:
    e = e.filter(F.col("event_type") == "view")
    chan = F.element_at(F.array(*[F.lit(c) for c in PAY_CHANNELS]), (_k() % 2 + 1).cast("int"))
    return e.select(F.col("user_id").cast("string").alias("tx_id"), chan.alias("pay_channel"),
                    "ts", F.col("event_id").alias("seq"), *keep)
