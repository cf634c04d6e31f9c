"""Filters and scalar expressions over event columns (all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's behaviour) -------------------
# File extensions treated as static assets by the page-view filter.
STATIC_EXTENSIONS = ("css", "js", "ico", "png")
# Polynomial string hash of the hashed-bitmap unique-visitor count:
# multiplier 61 over the string's UTF-16 code units, reduced to 2^29 bits.
POLY_SEED = 61
POLY_BITS = 29
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def only(df: DataFrame, col: str, value) -> DataFrame:
    """Keep rows whose ``col`` equals ``value`` (pushed down to the scan)."""
    return df.filter(_c(col) == F.lit(value))


def exclude(df: DataFrame, col: str, value) -> DataFrame:
    """Drop rows whose ``col`` equals ``value``; null is not equal, so it stays."""
    return df.filter(~_c(col).eqNullSafe(F.lit(value)))


def static_asset_pattern(exts: Iterable[str] = STATIC_EXTENSIONS) -> str:
    return r"\.(" + "|".join(exts) + r")$"


def drop_static_assets(df: DataFrame, url: str = "url",
                       exts: Iterable[str] = STATIC_EXTENSIONS) -> DataFrame:
    """Drop requests for static files: the URL *ends* with ``.<ext>``.

    End-anchored, so ``/a.js?v=1`` is kept and ``/a.js`` dropped.
    """
    return df.filter(~_c(url).rlike(static_asset_pattern(exts)))


def poly_hash(s, seed: int = POLY_SEED, bits: int = POLY_BITS) -> Column:
    """``h = h * seed + code_unit`` over the string, masked to ``bits`` bits.

    Masking after every step equals 64-bit wrap-around followed by one mask
    (the mask is 2^bits - 1 and 2^bits divides 2^64), and it keeps the
    intermediate small so ANSI mode never overflows.
    """
    mask = (1 << bits) - 1
    codes = F.transform(F.split(_c(s), ""), lambda ch: F.ascii(ch).cast("bigint"))
    return F.aggregate(codes, F.lit(0).cast("bigint"),
                       lambda acc, x: (acc * F.lit(seed) + x).bitwiseAND(F.lit(mask)))


def salt(cols: Iterable, n: int) -> Column:
    """Deterministic salt in ``0..n-1`` (a retried task gets the same salt)."""
    return F.pmod(F.xxhash64(*[_c(c) for c in cols]), F.lit(n)).cast("int")
