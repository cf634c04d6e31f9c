"""Incremental changelog of a top-n ranking (O-06 S): what a micro-batch changes, and nothing else.

The state of a window is a map from key to count and its last ranking.  Counts
only grow, so the new ranking is made of the last one and of the keys the
micro-batch touched; no other count is read.  Work and output follow the
micro-batch, not the history.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from eventide.functions.time import from_micros, micros
from eventide.operators.windows import us

US_PER_MS = 1000


class RankingChanges(StatefulProcessor):
    """Adds counts to a window and emits the rows that its ranking loses (``-``) and gains (``+``)."""

    def __init__(self, key: str, key_ddl: str, n: int, ends: bool):
        self.key, self.key_ddl, self.n, self.ends = key, key_ddl, n, ends

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", self.key_ddl, "cnt long")
        self.ranking = handle.getListState("ranking", f"{self.key_ddl}, cnt long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (end,), by = key, Counter()
        for r in rows:
            by[r[0]] += r[1]
        was = [tuple(x) for x in self.ranking.get()] if self.ranking.exists() else []
        if self.ends and not was:
            self.handle.registerTimer(end // US_PER_MS)
        counts = dict(was)
        for k, more in by.items():
            counts[k] = more + (self.counts.getValue((k,))[0] if self.counts.containsKey((k,)) else 0)
            self.counts.updateValue((k,), (counts[k],))
        now = heapq.nsmallest(self.n, counts.items(), key=lambda x: (-x[1], x[0]))
        if now != was:
            self.ranking.put(now)
        old, new = ({(k, c, i) for i, (k, c) in enumerate(top, 1)} for top in (was, now))
        return iter([Row(op=op, **{self.key: k}, end_us=end, cnt=c, rank=i)
                     for op, rows_ in (("-", old - new), ("+", new - old)) for k, c, i in sorted(rows_, key=lambda x: x[2])])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.counts.clear()
        self.ranking.clear()
        return iter([])

    def close(self) -> None:
        pass


def _combined(schema: pa.Schema, size: int, slide: int) -> Callable:
    """Per Arrow batch one row per (window, key): a partial count before the shuffle."""
    def run(batches):
        for b in batches:
            by: Counter = Counter(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            out: Counter = Counter()
            for (k, at), c in by.items():
                for start in range(at - at % slide, at - size, -slide):
                    out[k, start + size] += c
            cols = list(zip(*((k, c, end, end) for (k, end), c in out.items()))) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()).cast(f.type) if f.name == "event_time" else
                                              pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def stream_changelog(rows: DataFrame, key: str, key_ddl: str, n: int, size, slide, delay=None) -> DataFrame:
    """O-06 S: ``(op, key, window_end, cnt, rank)``, the add and retract rows of the top ``n`` of every sliding window.

    ``rows`` has the key and ``ts``; rows without either are left out.  Ranks by
    count descending, then key ascending.  ``sinks.net_rows`` of all rows so far
    is the ranking of all input so far.  With ``delay`` a window's state is
    dropped once the watermark passes its end, and rows that come later do not
    count; without, every window stays open.  The watermark runs on window ends, so
    it is ``size`` later still: it never passes the latest row less ``delay``, and
    is at most a slide behind that.  A window's touched keys of a micro-batch meet
    in one task, counted per Arrow batch before.
    """
    slide_us, size_us = us(slide), us(size)
    schema = StructType([StructField(key, rows.schema[key].dataType), StructField("more", LongType()),
                         StructField("end_us", LongType()), StructField("event_time", TimestampType())])
    d = rows.where(F.col(key).isNotNull() & F.col("ts").isNotNull()).select(key, micros("ts").alias("us"))
    d = d.mapInArrow(_combined(to_arrow_schema(schema), size_us, slide_us), schema)
    if delay is not None:
        d = d.withWatermark("event_time", f"{-(-(us(delay) + size_us) // US_PER_MS)} milliseconds")
    else:
        d = d.drop("event_time")
    out = d.groupBy("end_us").transformWithState(
        RankingChanges(key, key_ddl, n, delay is not None), f"op string, {key_ddl}, end_us long, cnt long, rank long",
        "append", "None" if delay is None else "EventTime")
    return out.withColumn("window_end", from_micros("end_us")).select("op", key, "window_end", "cnt", "rank")
