"""Text / CSV event files (O-01) and the line parsers of each record type (O-08..O-13).

Every parser takes a frame with one string column of raw lines (``value``, the
shape of ``spark.read.text`` and of a Kafka value) and returns typed columns
(plus the columns named in ``keep``, e.g. an arrival sequence).
Fields are split by position and cast with ``try_cast``: a malformed line does
not fail the job, it yields nulls and is flagged in ``_corrupt`` (the
reference throws instead).  Event times become ``timestamp_ntz`` (UTC) plus the
untouched line order is not assumed anywhere: callers pass a ``seq`` column
when arrival order matters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import US_PER_MS, from_micros, from_seconds

# ---- fixed values: field layouts of the reference's inputs ---------------
# UserBehavior.csv : user_id, item_id, category_id, behavior, ts (seconds)
# AdClickLog.csv   : user_id, ad_id, province, city, ts (seconds)
# LoginLog.csv     : user_id, ip, event_type, ts (seconds)
# OrderLog.csv     : order_id, event_type, tx_id (empty for create), ts (seconds)
# ReceiptLog.csv   : tx_id, pay_channel, ts (seconds)
# apache.log       : space separated; 0 ip, 1 user_id, 3 time, 5 method, 6 url
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
# ---------------------------------------------------------------------------


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw lines of text files as column ``value`` (batch or stream).

    Large files are split by ``spark.sql.files.maxPartitionBytes``; a stream
    picks up new files of the folder at each trigger.
    """
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path)
    return spark.read.text(path)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parsed(lines: DataFrame, value: str, sep: str, keep: tuple, fields: Callable[[Column], dict]) -> DataFrame:
    """The fields of each line, and ``_corrupt``: whether one is missing or unreadable.

    A line is split and converted once, by a generator of one row: plain columns
    would be put into every later filter and computed again there.
    """
    names: list[str] = []

    def whole(a: Column) -> Column:
        cols = fields(a)
        names[:] = cols
        return F.struct(*[c.alias(n) for n, c in cols.items()])

    def flagged(r: Column) -> Column:
        bad = F.lit(False)
        for n in names:
            bad = bad | r[n].isNull()
        return F.struct(*[r[n].alias(n) for n in names], bad.alias("_corrupt"))

    one = F.transform(F.array(F.split(F.col(value), sep, -1)), lambda a: _let(whole(a), flagged))
    return lines.select(F.inline(one), *keep)


def _at(arr: Column, i: int) -> Column:
    return F.get(arr, i)


def parse_user_behavior(lines: DataFrame, value: str = "value", keep: tuple = ()) -> DataFrame:
    """O-08: ``user_id,item_id,category_id,behavior,ts_seconds``."""
    return _parsed(lines, value, ",", keep, lambda a: {
        "user_id": _at(a, 0).try_cast("bigint"),
        "item_id": _at(a, 1).try_cast("bigint"),
        "category_id": _at(a, 2).try_cast("int"),
        "behavior": _at(a, 3),
        "ts": from_seconds(_at(a, 4).try_cast("bigint")),
    })


def parse_ad_click(lines: DataFrame, value: str = "value", keep: tuple = ()) -> DataFrame:
    """O-09: ``user_id,ad_id,province,city,ts_seconds``."""
    return _parsed(lines, value, ",", keep, lambda a: {
        "user_id": _at(a, 0).try_cast("bigint"),
        "ad_id": _at(a, 1).try_cast("bigint"),
        "province": _at(a, 2),
        "city": _at(a, 3),
        "ts": from_seconds(_at(a, 4).try_cast("bigint")),
    })


def parse_login(lines: DataFrame, value: str = "value", keep: tuple = ()) -> DataFrame:
    """O-10: ``user_id,ip,event_type,ts_seconds``."""
    return _parsed(lines, value, ",", keep, lambda a: {
        "user_id": _at(a, 0).try_cast("bigint"),
        "ip": _at(a, 1),
        "event_type": _at(a, 2),
        "ts": from_seconds(_at(a, 3).try_cast("bigint")),
    })


def parse_order(lines: DataFrame, value: str = "value", keep: tuple = ()) -> DataFrame:
    """O-11: ``order_id,event_type,tx_id,ts_seconds``; ``tx_id`` is empty for creates."""
    return _parsed(lines, value, ",", keep, lambda a: {
        "order_id": _at(a, 0).try_cast("bigint"),
        "event_type": _at(a, 1),
        "tx_id": _at(a, 2),
        "ts": from_seconds(_at(a, 3).try_cast("bigint")),
    })


def parse_receipt(lines: DataFrame, value: str = "value", keep: tuple = ()) -> DataFrame:
    """O-12: ``tx_id,pay_channel,ts_seconds``."""
    return _parsed(lines, value, ",", keep, lambda a: {
        "tx_id": _at(a, 0),
        "pay_channel": _at(a, 1),
        "ts": from_seconds(_at(a, 2).try_cast("bigint")),
    })


def parse_access_log(lines: DataFrame, value: str = "value", honour_zone: bool = False,
                     keep: tuple = ()) -> DataFrame:
    """O-13: web access log, fields 0 ip, 1 user_id, 3 time, 5 method, 6 url.

    The time ``dd/MM/yyyy:HH:mm:ss`` is read as UTC.  With ``honour_zone`` the
    zone field 4 (``+0800``) is applied; the reference ignores it.
    """
    def fields(a):
        ts = F.try_to_timestamp(_at(a, 3), F.lit(ACCESS_LOG_TIME_FORMAT)).cast("timestamp_ntz")
        if honour_zone:
            z = _at(a, 4)
            sign = F.when(F.substring(z, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
            offs_min = (F.substring(z, 2, 2).try_cast("int") * 60
                        + F.substring(z, 4, 2).try_cast("int")) * sign
            ts = F.timestamp_add("MINUTE", -offs_min, ts)
        return {"ip": _at(a, 0), "user_id": _at(a, 1), "ts": ts, "method": _at(a, 5), "url": _at(a, 6)}

    return _parsed(lines, value, " ", keep, fields)


def market_from_millis(df: DataFrame, ms_col: str = "ts_ms") -> DataFrame:
    """Market events carry epoch milliseconds; convert to an NTZ ``ts``."""
    return df.withColumn("ts", from_micros(F.col(ms_col) * F.lit(US_PER_MS)))
