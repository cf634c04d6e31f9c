"""Event time and watermarks for streams (O-43, O-44)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import micros


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = "0 seconds",
                    out: str = "event_time") -> DataFrame:
    """Declare event time with a bounded-out-of-orderness watermark.

    ``delay='0 seconds'`` is the ascending-timestamps case (O-43), a positive
    delay the bounded case (O-44).  ``withWatermark`` rejects ``timestamp_ntz``
    (contract C11), so the NTZ instant is rebuilt as a ``timestamp`` from its
    epoch microseconds (zone-free) in column ``out``; ``ts_us`` keeps the
    exact microseconds for stateful processors.  Catalyst pushes later filters
    below the watermark, so it follows the rows that a job itself reads.
    """
    us = micros(ts)
    return df.withColumn("ts_us", us) \
             .withColumn(out, F.timestamp_micros(us)) \
             .withWatermark(out, delay)
