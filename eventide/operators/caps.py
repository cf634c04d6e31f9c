"""Per-key daily cap with a one-time warning (O-33)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import local_day

# ---- fixed values: warning text of the reference --------------------------
CAP_MSG = "Click Over %d times today."
# ---------------------------------------------------------------------------


def rate_cap(df: DataFrame, keys: list[str], n: int, tz: str = "Asia/Shanghai") -> DataFrame:
    """The first ``n + 1`` rows of each (keys, local day of ``tz``) in ``(ts, seq)`` order.

    Adds ``day`` and ``day_rank`` (1-based); rank ``n + 1`` raises the warning
    and nothing beyond it is ever emitted.  Catalyst turns the bound into a
    partial group limit, so a task forwards at most ``n + 1`` rows of a hot
    (user, ad, day) to the shuffle.  Rows without a time have no day and go.
    Contract C8: the day resets at event-time local midnight.
    """
    d = df.where("ts is not null").withColumn("day", local_day("ts", tz))
    w = Window.partitionBy(*keys, "day").orderBy("ts", "seq")
    ranked = d.withColumn("day_rank", F.row_number().over(w)).where(F.col("day_rank") <= n + 1)
    return ranked.withColumn("day_rank", F.col("day_rank").cast("bigint"))


def cap_passed(ranked: DataFrame, n: int) -> DataFrame:
    """Rows that pass the cap: the first ``n`` per key and day."""
    return ranked.filter(F.col("day_rank") <= n).drop("day_rank")


def cap_warnings(ranked: DataFrame, keys: list[str], n: int) -> DataFrame:
    """One warning per key and day, raised by the ``n+1``-th row; later rows drop silently."""
    return ranked.filter(F.col("day_rank") == n + 1).select(
        *keys, "day", "ts", F.lit(CAP_MSG % n).alias("msg"))
