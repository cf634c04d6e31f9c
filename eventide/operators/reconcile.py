"""Two-stream operators: interval join (O-40) and one-to-one reconciliation (O-41, O-42)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventide.functions.time import micros
from eventide.operators.scan import Running, keyed_scan, time_bucket
from eventide.operators.windows import us

HOUR_US = 3_600_000_000


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], lower, upper,
                  how: str = "inner", inclusive: bool = True, lts: str = "ts",
                  rts: str = "ts", bucket_width=None, left_id: list[str] | None = None,
                  right_id: list[str] | None = None) -> DataFrame:
    """O-40: join rows with equal keys where ``right.ts - left.ts`` is in ``[lower, upper]``.

    A plain equi-join on the key would pair every left row with every right
    row of the key and filter afterwards (quadratic on a hot key).  Here the
    right side is bucketed by time (width >= upper - lower) and each left row
    probes only the one or two buckets its range touches, so the equi-join
    key is ``(key, bucket)`` and candidate pairs stay proportional to the
    matches.  Columns other than the keys must not clash between sides
    (rename first); result: keys, left columns, right columns.

    ``how`` = ``left`` / ``right`` / ``full`` adds the rows of that side
    without any match (other side null): matched rows are removed from the
    side by an anti-join on ``left_id`` / ``right_id`` (columns identifying a
    row; all its columns by default), never by pairing all rows of a key.
    """
    lo, hi = us(lower), us(upper)
    width = us(bucket_width) if bucket_width is not None else max(hi - lo, 1)
    l_us, r_us = micros(F.col(lts)), micros(F.col(rts))
    lb0 = ((l_us + F.lit(lo)) - F.pmod(l_us + F.lit(lo), F.lit(width))) / F.lit(width)
    lb1 = ((l_us + F.lit(hi)) - F.pmod(l_us + F.lit(hi), F.lit(width))) / F.lit(width)
    lx = left.withColumn("_jb", F.explode(F.sequence(lb0.cast("bigint"), lb1.cast("bigint"))))
    rx = right.withColumn("_jb", ((r_us - F.pmod(r_us, F.lit(width))) / F.lit(width)).cast("bigint"))
    la, ra = lx.alias("_l"), rx.alias("_r")
    gap = micros(F.col(f"_r.{rts}")) - micros(F.col(f"_l.{lts}"))
    rng = ((gap >= F.lit(lo)) & (gap <= F.lit(hi))) if inclusive else \
        ((gap > F.lit(lo)) & (gap < F.lit(hi)))
    cond = [F.col(f"_l.{k}") == F.col(f"_r.{k}") for k in keys] + \
           [F.col("_l._jb") == F.col("_r._jb"), rng]
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    j = la.join(ra, cond_all, "inner")
    lcols = [F.col(f"_l.{c}") for c in left.columns]
    rcols = [F.col(f"_r.{c}") for c in right.columns if c not in keys]
    inner = j.select(*lcols, *rcols)
    if how == "inner":
        return inner
    out = inner
    rschema = {f.name: f.dataType for f in right.schema.fields}
    lschema = {f.name: f.dataType for f in left.schema.fields}
    if how in ("left", "full"):
        lone = _unmatched(left, inner, left_id or list(left.columns))
        out = out.unionByName(lone.select(*left.columns, *[F.lit(None).cast(rschema[c]).alias(c)
                                                           for c in right.columns if c not in keys]))
    if how in ("right", "full"):
        rone = _unmatched(right, inner, right_id or list(right.columns))
        out = out.unionByName(rone.select(*[F.lit(None).cast(lschema[c]).alias(c) if c not in keys
                                            else F.col(c) for c in left.columns],
                                          *[c for c in right.columns if c not in keys]))
    return out


def _unmatched(side: DataFrame, inner: DataFrame, ids: list[str]) -> DataFrame:
    """Rows of ``side`` whose identity ``ids`` is absent from the matches (null-safe)."""
    s, m = side.alias("_s"), inner.select(*ids).distinct().alias("_m")
    cond = None
    for c in ids:
        e = F.col(f"_s.{c}").eqNullSafe(F.col(f"_m.{c}"))
        cond = e if cond is None else cond & e
    return s.join(m, cond, "left_anti").select("_s.*")


def reconcile(left: DataFrame, right: DataFrame, key: str, wait_left, wait_right,
              left_cols: list[str], right_cols: list[str], carry_width=HOUR_US) -> DataFrame:
    """O-41 / O-42: one-to-one matching of two streams per key with per-side patience (C7).

    Both sides are merged per key in ``(ts, side, seq)`` order (left first on
    a tie).  A row pairs with the row just before it iff that row is of the
    other side, not paired yet, and waited at most its side's patience
    (``wait_left`` for a pending left row, ``wait_right`` for a pending
    right row; inclusive).  A row of the same side overwrites the pending one,
    which stays unmatched.

    Equivalently: a *chain* restarts where the previous row is same-side or
    out of patience; inside a chain sides alternate and positions (1,2),
    (3,4), .. pair up.  Two keyed scans: one for chain starts, one for the
    chain head's side and the next row's start flag.

    Returns rows with ``tag`` = ``MATCH`` (both sides set) or ``UNMATCHED``
    (exactly one side set), columns: key, tag, ``left`` struct, ``right`` struct.
    """
    wl, wr = us(wait_left), us(wait_right)
    lstruct = F.struct(*[F.col(c) for c in left_cols])
    rstruct = F.struct(*[F.col(c) for c in right_cols])
    lu = left.select(F.col(key), F.col("ts"), F.col("seq"), F.lit(0).alias("_side"),
                     lstruct.alias("_lv"), F.lit(None).cast(rstruct_type(right, right_cols)).alias("_rv"))
    ru = right.select(F.col(key), F.col("ts"), F.col("seq"), F.lit(1).alias("_side"),
                      F.lit(None).cast(rstruct_type(left, left_cols)).alias("_lv"), rstruct.alias("_rv"))
    u = lu.unionByName(ru)
    order = ["ts", "_side", "seq"]
    bucket = time_bucket(micros("ts"), us(carry_width))
    s1 = keyed_scan(u, [key], order, bucket, prev=["_side", "ts", "_lv", "_rv"])
    patience = F.when(F.col("prev__side") == 0, F.lit(wl)).otherwise(F.lit(wr))
    start = (F.col("prev__side").isNull() | (F.col("prev__side") == F.col("_side"))
             | ((micros("ts") - micros("prev_ts")) > patience))
    s1 = s1.withColumn("_start", start)
    head = F.when(F.col("_start"), F.struct(F.col("ts").alias("ts"), F.col("_side").alias("side"),
                                            F.col("seq").alias("seq")))
    s2 = keyed_scan(s1, [key], order, bucket, next=["_start"],
                    running=[Running("_head", head, "max", "prefix", True)])
    head_side = F.col("_head.side")
    second = ~F.col("_start") & (F.col("_side") != head_side)
    first = (F.col("_side") == head_side) & (F.col("next__start") == F.lit(False))
    matched = s2.filter(second).select(
        key, F.lit("MATCH").alias("tag"),
        F.when(F.col("_side") == 0, F.col("_lv")).otherwise(F.col("prev__lv")).alias("left"),
        F.when(F.col("_side") == 1, F.col("_rv")).otherwise(F.col("prev__rv")).alias("right"))
    unmatched = s2.filter(~second & ~F.coalesce(first, F.lit(False))).select(
        key, F.lit("UNMATCHED").alias("tag"), F.col("_lv").alias("left"), F.col("_rv").alias("right"))
    return matched.unionByName(unmatched)


def rstruct_type(df: DataFrame, cols: list[str]) -> StructType:
    """Struct of ``cols`` of ``df``, whatever their types (for the typed null side)."""
    return StructType([df.schema[c] for c in cols])
