"""Distinct visitors per window (O-29..O-31)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.text import POLY_BITS, POLY_SEED, poly_hash
from eventide.functions.time import from_micros, micros
from eventide.operators.scan import Running, keyed_scan, time_bucket
from eventide.operators.windows import pane_end_us, us


def uv_exact(df: DataFrame, size, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """O-29: exact distinct users per tumbling window -> window_end, uv.

    Deduplicates (window, user) with a partial aggregate first, so no window
    is ever gathered as a set; then counts per window.
    """
    size_us = us(size)
    pairs = df.where(F.col(ts).isNotNull()).select(pane_end_us(ts, size_us).alias("_e"), F.col(user).alias("_u")).distinct()
    return pairs.groupBy("_e").agg(F.count(F.lit(1)).alias("uv")) \
                .select(from_micros("_e").alias("window_end"), "uv")


def user_hash(user: str = "user_id", seed: int = POLY_SEED, bits: int = POLY_BITS):
    """Bitmap offset of a user: polynomial hash of its decimal text."""
    return poly_hash(F.col(user).cast("string"), seed, bits)


def uv_bitmap(df: DataFrame, size, user: str = "user_id", ts: str = "ts",
              seed: int = POLY_SEED, bits: int = POLY_BITS) -> DataFrame:
    """O-30: distinct hash offsets per window, counted with Spark bitmaps.

    Offsets are split into 32K-bit chunks (``bitmap_bucket_number``); each
    (window, chunk) bitmap is built by a mergeable aggregate, so only touched
    chunks exist (the reference keeps one 64 MB bitmap per window).  Hash
    collisions undercount exactly as the reference's single-hash filter does.
    """
    size_us = us(size)
    h = user_hash(user, seed, bits)
    chunks = df.where(F.col(ts).isNotNull()).select(pane_end_us(ts, size_us).alias("_e"), h.alias("_h")) \
        .groupBy("_e", F.bitmap_bucket_number("_h").alias("_b")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_bm"))
    return chunks.groupBy("_e").agg(F.sum(F.bitmap_count("_bm")).alias("uv")) \
                 .select(from_micros("_e").alias("window_end"), "uv")


def uv_running(df: DataFrame, size, user: str = "user_id", ts: str = "ts", seq: str = "seq",
               seed: int = POLY_SEED, bits: int = POLY_BITS, carry_width=None) -> DataFrame:
    """O-31: distinct count per window as it grows, one row per count change.

    A row changes the count when its hash offset is new in its window; the
    first occurrence per (window, offset) is a min aggregate (no per-window
    sort), and the running count is a skew-safe scan per window.
    Returns window_end, ts, seq, uv (count after that row).
    """
    size_us = us(size)
    h = user_hash(user, seed, bits)
    firsts = df.where(F.col(ts).isNotNull()).groupBy(pane_end_us(ts, size_us).alias("_e"), h.alias("_h")) \
        .agg(F.min(F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"))).alias("_f")) \
        .select("_e", "_f.ts", "_f.seq")
    width = us(carry_width) if carry_width is not None else max(size_us // 60, 1)
    sc = keyed_scan(firsts, ["_e"], ["ts", "seq"], time_bucket(micros("ts"), width),
                    running=[Running("uv", F.lit(1), "sum")])
    return sc.select(from_micros("_e").alias("window_end"), "ts", "seq",
                     F.col("uv").cast("bigint").alias("uv"))
