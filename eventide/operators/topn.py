"""Per-window ranking (O-34, O-34c, O-32), ranking text (O-22) and changelog (O-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.functions.time import micros, ts_text

# ---- fixed values: text layout of the reference's ranking report ----------
REPORT_HEAD = "窗口结束时间："          # "window end time:" followed by the end instant
ITEM_LINE = "NO{rank}: 商品ID={key}\t 点击量={cnt}\t 窗口结束时间={end_ms}\n"
PAGE_LINE = "NO{rank}: 链接地址={key}\t 点击量={cnt}\n"
REPORT_RULE = "========================\n\n"
# ---------------------------------------------------------------------------


def topn_per_window(df: DataFrame, n: int, key: str, window: str = "window_end",
                    count: str = "cnt", rank_name: str = "rank") -> DataFrame:
    """O-34: the ``n`` largest counts per window, ties by key ascending.

    ``row_number() <= n`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so each task forwards at most ``n`` rows per window.
    """
    w = Window.partitionBy(window).orderBy(F.col(count).desc(), F.col(key).asc())
    return df.withColumn(rank_name, F.row_number().over(w).cast("bigint")) \
             .filter(F.col(rank_name) <= n)


def latest_per_key(df: DataFrame, keys: list[str], version: str, cols: list[str]) -> DataFrame:
    """Latest value per key by ``version`` (late re-firings replace, never add)."""
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(version)).alias("_v")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in cols])


def ranking_report(topn: DataFrame, key: str, window: str = "window_end", count: str = "cnt",
                   rank: str = "rank", line: str = ITEM_LINE) -> DataFrame:
    """O-22: one text block per window: head line, one line per rank, rule.

    Only the top-n rows of a window are collected, so the list is bounded by n.
    """
    item = F.format_string(
        line.replace("{rank}", "%d").replace("{key}", "%s").replace("{cnt}", "%d")
        .replace("{end_ms}", "%d"),
        *([F.col(rank), F.col(key).cast("string"), F.col(count)]
          + ([(micros(window) / 1000).cast("bigint")] if "{end_ms}" in line else [])))
    rows = topn.select(window, F.struct(F.col(rank).alias("r"), item.alias("t")).alias("_x"))
    blocks = rows.groupBy(window).agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
    text = F.concat(F.lit(REPORT_HEAD), ts_text(F.col(window)), F.lit("\n"),
                    F.array_join(F.transform("_xs", lambda x: x["t"]), ""), F.lit(REPORT_RULE))
    return blocks.select(window, text.alias("report"))


HOT_ITEMS_SQL_AGG = """
SELECT item_id,
       window(ts, '1 hour', '5 minutes').end AS window_end,
       count(item_id) AS cnt
FROM {view}
WHERE behavior = 'pv'
GROUP BY item_id, window(ts, '1 hour', '5 minutes')
"""

HOT_ITEMS_SQL_TOPN = """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS BIGINT)
         AS row_num
  FROM {view}
) t WHERE row_num <= {n}
"""


def hot_items_sql(spark: SparkSession, behavior: DataFrame, n: int = 5,
                  view: str = "user_behavior") -> DataFrame:
    """O-18/O-32/O-34c: the SQL form -- hop window count, then SQL top-n."""
    behavior.select("item_id", "behavior", "ts").createOrReplaceTempView(view)
    agg = spark.sql(HOT_ITEMS_SQL_AGG.format(view=view))
    agg.createOrReplaceTempView(view + "_agg")
    return spark.sql(HOT_ITEMS_SQL_TOPN.format(view=view + "_agg", n=n))


def changelog(prev: DataFrame, curr: DataFrame, op: str = "op") -> DataFrame:
    """O-06: add/retract rows turning result ``prev`` into ``curr``.

    ``-`` rows are in ``prev`` but not ``curr``, ``+`` rows the reverse
    (multiset difference, so duplicates are kept).
    """
    cols = curr.columns
    retract = prev.select(*cols).exceptAll(curr.select(*cols)).withColumn(op, F.lit("-"))
    add = curr.select(*cols).exceptAll(prev.select(*cols)).withColumn(op, F.lit("+"))
    return retract.unionByName(add)
