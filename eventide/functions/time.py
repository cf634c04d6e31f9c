"""Event-time helpers that do not depend on the session time zone.

Event times are ``timestamp_ntz`` instants read as UTC.  Arithmetic is done on
epoch microseconds.  With a UTC session clock (what the registered queries and
``build_session`` set) the conversion is a plain cast; under any other session
zone the zone-free ``timestamp_diff`` / ``timestamp_add`` are used, so results
never depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_MS = 1_000
US_PER_S = 1_000_000


def ntz_literal(text: str) -> Column:
    """An NTZ instant from ``yyyy-MM-dd HH:mm:ss`` text (no zone involved)."""
    return F.lit(text).cast("timestamp_ntz")


def epoch() -> Column:
    """The epoch as an NTZ literal (built lazily: columns need an active session)."""
    return ntz_literal("1970-01-01 00:00:00")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_FIXED_UTC = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Etc/Universal", "Universal", "Zulu"}


def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    return s is not None and s.conf.get("spark.sql.session.timeZone", "") in _FIXED_UTC


def micros(ts) -> Column:
    """Epoch microseconds of an NTZ timestamp (UTC reading).

    With a UTC session clock the NTZ -> timestamp cast is the identity, so the
    cheap ``unix_micros(cast)`` is exact; otherwise the zone-free
    ``timestamp_diff`` (slower per row) is used.
    """
    if _session_is_utc():
        return F.unix_micros(_c(ts).cast("timestamp"))
    return F.timestamp_diff("MICROSECOND", epoch(), _c(ts))


def from_micros(us) -> Column:
    """NTZ timestamp from epoch microseconds (see ``micros`` for the two paths)."""
    if _session_is_utc():
        return F.timestamp_micros(_c(us)).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", _c(us), epoch())


def from_seconds(s) -> Column:
    """NTZ timestamp from epoch seconds (the reference's CSV time unit)."""
    return from_micros(_c(s).cast("bigint") * F.lit(US_PER_S))


def ts_text(ts) -> Column:
    """``java.sql.Timestamp.toString`` rendering: ``yyyy-MM-dd HH:mm:ss.f``.

    The fraction keeps its significant digits and is at least one digit
    (``...:00.0``, ``...:00.25``).
    """
    t = _c(ts)
    frac = F.regexp_replace(F.date_format(t, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit("."),
                    F.when(frac == "", F.lit("0")).otherwise(frac))


def local_day(ts, tz: str = "Asia/Shanghai") -> Column:
    """Calendar day of a UTC instant in zone ``tz``."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts)))
