"""Late data in streams (O-45, O-46, O-34b): the contract C9 across micro-batches.

Spark's own watermark moves once per micro-batch and drops late rows silently.
The contract judges each row by the watermark in force when it arrives: the
latest event time of all rows before it, less the bound.  Two jobs state that:

1. :func:`split_late` classifies.  The latest event time of all earlier
   micro-batches is a value in the state store, fed with one summary row per
   Arrow batch, so it is committed with the stream's checkpoint; inside a
   micro-batch the prefix maximum is the skew-safe scan of the batch operator.
   Rows that every window has expired for are the side output; the others go on
   as rows with their window ranges, and a marker row closes each micro-batch.
2. :func:`stream_lateness_counts` and :func:`stream_hot_pages` read those rows as
   a stream whose event time *is* the contract's watermark (that at the start of
   the row's micro-batch, and at its end for the marker), so no row is late for
   Spark and timers fire when the contract says a window is due.  Counts are kept in map state: a window fires
   at its end, fires again with a higher version on every late update, and
   leaves the state when the allowed lateness has passed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.time import from_micros, micros
from eventide.operators.late import window_ranges, with_watermark_before
from eventide.operators.windows import us
from eventide.streaming.sinks import run_stream

US_PER_MS = 1000
RANGES = ("_ts_us long, wm_us long, _first_end long, _last_end long, _acc_from long, _on_from long, "
          "_at_us long, _marker boolean")


class CarriedMax(StatefulProcessor):
    """Value state: the latest event time seen.  Emits the one before this micro-batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("latest", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.state.get()[0] if self.state.exists() else None
        latest = max([r.us for r in rows if r.us is not None] + ([] if before is None else [before]), default=None)
        if latest is not None:
            self.state.update((latest,))
        return iter([Row(before=before)])

    def close(self) -> None:
        pass


def _summaries(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([pc.max(b.column(0)).as_py()], pa.int64())], names=["us"])


def split_late(rows: DataFrame, path: str, bound, allowed, size, slide, seq: str = "seq", tie: str | None = None,
               ts: str = "ts", name: str = "late", counts: list[str] | None = None, **run) -> None:
    """Run the classifying job: ``path/late`` gets the side output, ``path/rows`` all others with their ranges.

    With ``counts``, ``path/rows`` has instead the number ``n`` of the rows that agree in
    these columns and in their ranges, for a job that only counts.

    Each micro-batch overwrites its own folder, so a retried one leaves the same
    rows.  Rows are in arrival order by ``(seq, tie)`` within a micro-batch; every
    micro-batch comes after those before it.  Rows without a time are in neither.
    """
    rows = rows.where(F.col(ts).isNotNull())
    latest = rows.select(micros(ts).alias("us")).mapInArrow(_summaries, "us long").withColumn("all", F.lit(0))
    carried = latest.groupBy("all").transformWithState(CarriedMax(), "before long", "append", "None")
    row = F.struct(*rows.columns).alias("row")
    none = F.lit(None).cast(rows.select(row).schema[0].dataType).alias("row")
    both = rows.select(F.lit(None).cast("long").alias("before"), row).unionByName(carried.select("before", none))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            of = batch.agg(F.max("before").alias("before"), F.max(micros(F.col(f"row.{ts}"))).alias("latest")).first()
            at = None if of.before is None else of.before - us(bound)
            r = window_ranges(with_watermark_before(batch.where("row is not null").select("row.*"), bound, seq, tie, ts,
                                                    initial_max_us=of.before), size, slide, allowed)
            r = r.withColumn("_at_us", F.lit(at).cast("long")).withColumn("_marker", F.lit(False))
            gone = F.col("_acc_from") > F.col("_last_end")
            r.where(gone).select(*rows.columns, from_micros("wm_us").alias("wm")) \
                .write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            kept = r.where(~gone)
            if counts is not None:
                kept = kept.groupBy(*counts, "_acc_from", "_on_from", "_last_end", "_at_us", "_marker").agg(
                    F.count(F.lit(1)).alias("n"))
            kept.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
            # the marker's file comes after all others of the batch: who sees it sees them
            end = max([x for x in (of.before, of.latest) if x is not None], default=None)
            ranges = {c.split()[0]: F.lit(0).cast("long") for c in RANGES.split(", ")}
            ranges |= {"_at_us": F.lit(None if end is None else end - us(bound)).cast("long"), "_marker": F.lit(True)}
            blank = [ranges.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kept.schema]
            batch.sparkSession.range(1).select(*blank).write.mode("overwrite").parquet(f"{path}/rows/end={batch_id}")
        finally:
            batch.unpersist()

    run_stream(both, write, name=name, **run)


def accepted_rows(spark: SparkSession, path: str, rows_ddl: str, max_files: int | None = None) -> DataFrame:
    """``path/rows`` as a stream whose event time is the contract's watermark.

    Spark's watermark lags by 1 ms, since it drops rows at the watermark itself.
    """
    r = spark.readStream.schema(f"{rows_ddl}, {RANGES}").option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    # the first rows of all have no watermark yet; they lie just behind Spark's first one, the epoch
    at = F.greatest(F.coalesce("_at_us", F.lit(0)), F.lit(2 * US_PER_MS))
    return r.parquet(f"{path}/rows").withColumn("event_time", F.timestamp_micros(at)).withWatermark(
        "event_time", "1 millisecond")


class _Due(StatefulProcessor):
    """One event-time timer per group, for the earliest instant at which something is due."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "ms long")

    def wake(self, at_us: int) -> None:
        """Have the timer fire once the contract's watermark has reached ``at_us``, or earlier."""
        ms = at_us // US_PER_MS - 1
        if self.due.exists():
            (known,) = self.due.get()
            if known <= ms:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    @staticmethod
    def now(timerValues) -> int:
        """The contract's watermark: Spark's lags by the 1 ms of :func:`accepted_rows`."""
        return (timerValues.getCurrentWatermarkInMs() + 1) * US_PER_MS

    def close(self) -> None:
        pass


class LatenessCounts(_Due):
    """O-45 / O-49: per key and day of windows a map from window to its counts and firing version."""

    ddl = "window_end_us long, cnt_on_time long, cnt long, late_updates long, version int"

    def __init__(self, keys: list[str], slide_us: int, allowed_us: int):
        self.keys, self.slide, self.allowed = keys, slide_us, allowed_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.windows = handle.getMapState("windows", "window_end long", "on_time long, late long, version int")

    def _row(self, key, end, on_time, late, version) -> Row:
        return Row(**dict(zip(self.keys, key)), window_end_us=end, cnt_on_time=on_time, cnt=on_time + late,
                   late_updates=late, version=version)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[int, list[int]] = {}
        for r in rows:
            if r.marker:
                continue
            for e in range(r.lo, r.hi + 1, self.slide):
                new.setdefault(e, [0, 0])[e < r.on_from] += getattr(r, "n", 1)
        out, known = [], self.due.exists()      # as long as the group has windows, a timer is due
        for e, (on_time, late) in new.items():
            version = 0
            if known and self.windows.containsKey((e,)):
                a, b, version = self.windows.getValue((e,))
                on_time, late = on_time + a, late + b
                if version:     # it has fired: the late rows fire it again
                    version += 1
                    out.append(self._row(key, e, on_time, late, version))
            self.windows.updateValue((e,), (on_time, late, version))
        if new:
            self.wake(min(new))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.due.clear()
        now, out, later, fired, gone = self.now(timerValues), [], [], [], []
        for (e,), (on_time, late, version) in [(tuple(k), tuple(v)) for k, v in self.windows.iterator()]:
            fires = not version and e <= now
            if fires:
                version = 1
                out.append(self._row(key, e, on_time, late, version))
            if e + self.allowed <= now:
                gone.append((e,))
                continue
            later.append(e + self.allowed if version else e)
            if fires:
                fired.append(((e,), (on_time, late, version)))
        if later:
            for k in gone:
                self.windows.removeKey(k)
            for k, v in fired:
                self.windows.updateValue(k, v)
            self.wake(min(later))
        else:
            self.windows.clear()
        return iter(out)


def stream_lateness_counts(rows: DataFrame, keys: list[str], allowed, slide, keys_ddl: str, span=None) -> DataFrame:
    """O-45 S: every firing of every (key, window): on-time count, count, late updates, version.

    ``rows`` as of :func:`accepted_rows`; a group of state holds the windows of
    one key that end within ``span`` (a day).  Where the rows have a column ``n``
    (``split_late`` with ``counts``), they count so many times.
    """
    slide_us, width = us(slide), us(span) if span is not None else 86_400_000_000
    n = F.col("n") if "n" in rows.columns else F.lit(1).cast("long").alias("n")
    dealt = _by_span(rows, slide_us, width, [*keys, F.col("_on_from").alias("on_from"), n])
    proc = LatenessCounts(keys, slide_us, us(allowed))
    return dealt.groupBy(*keys, "span").transformWithState(
        proc, f"{keys_ddl}, {proc.ddl}", "append", "EventTime")


def _by_span(rows: DataFrame, slide_us: int, width: int, columns: list) -> DataFrame:
    """Rows once per span of window ends that their accepted windows touch, with the ends ``lo`` to ``hi`` in it."""
    first = F.floor(F.col("_acc_from") / F.lit(width)).cast("bigint")
    last = F.floor(F.col("_last_end") / F.lit(width)).cast("bigint")
    span = rows.withColumn("span", F.explode(F.sequence(first, last)))
    start = F.col("span") * F.lit(width)
    up = start + F.pmod(-start, F.lit(slide_us))                                    # ends lie on the slide's grid
    stop = start + F.lit(width - 1)
    down = stop - F.pmod(stop, F.lit(slide_us))
    return span.select(*columns, "span", F.greatest("_acc_from", up).alias("lo"), F.least("_last_end", down).alias("hi"),
                       F.col("_marker").alias("marker"), "event_time").where("lo <= hi")


class HotPages(_Due):
    """O-34b / O-49: the changes of each page's count inside one span of windows, as map state.

    The map holds, per page and window end, by how much the page's count changes
    there.  One timer ranks the span's windows once the last has ended, another
    drops the map once the lateness has passed; rows in between rank it again.
    A ranking is emitted per run of windows with constant counts.
    """

    ddl = "span long, shard int, version int, from_us long, to_us long, page string, cnt long"

    def __init__(self, n: int, slide_us: int, width: int, allowed_us: int):
        self.n, self.slide, self.width, self.allowed = n, slide_us, width, allowed_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.changes = handle.getMapState("changes", "page string, window_end long", "by long")
        self.version = handle.getValueState("version", "n int")

    def _last(self, span: int) -> int:
        stop = (span + 1) * self.width - 1
        return stop - stop % self.slide

    def _ranking(self, key) -> list[Row]:
        (span, shard), last = key, self._last(key[0])
        version = (self.version.get()[0] if self.version.exists() else 0) + 1
        self.version.update((version,))
        at: dict[int, list] = {}
        for k, v in self.changes.iterator():
            at.setdefault(k[1], []).append((k[0], v[0]))
        counts: dict[str, int] = {}
        out, ends = [], sorted(at)
        for i, e in enumerate(ends):
            for page, by in at[e]:
                counts[page] = counts.get(page, 0) + by
                if not counts[page]:
                    del counts[page]
            to = ends[i + 1] - self.slide if i + 1 < len(ends) else last
            best = heapq.nsmallest(self.n, counts.items(), key=lambda x: (-x[1], x[0]))
            out += [Row(span=span, shard=shard, version=version, from_us=e, to_us=to, page=p, cnt=c) for p, c in best]
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[tuple, int] = {}
        last = self._last(key[0])
        for r in rows:
            if r.marker:
                continue
            new[r.page, r.lo] = new.get((r.page, r.lo), 0) + 1
            if r.hi < last:
                end = (r.page, r.hi + self.slide)
                new[end] = new.get(end, 0) - 1
        for k, by in new.items():
            if self.changes.containsKey(k):
                by += self.changes.getValue(k)[0]
            self.changes.updateValue(k, (by,))
        if not new:
            return iter([])
        if self.version.exists():       # ranked before: the late rows rank it again
            return iter(self._ranking(key))
        self.wake(last)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.due.clear()
        now, last, out = self.now(timerValues), self._last(key[0]), []
        if not self.version.exists() and last <= now:
            out = self._ranking(key)
        if last + self.allowed <= now:
            self.changes.clear()
            self.version.clear()
        else:
            self.wake(last if not self.version.exists() else last + self.allowed)
        return iter(out)


def stream_hot_pages(rows: DataFrame, page: str, n: int, allowed, slide, span, shards: int = 4) -> DataFrame:
    """O-34b S: refined rankings; :func:`last_rankings` turns them into rows per window.

    A group of state holds the windows that end within ``span`` and the pages of
    one of ``shards``, so a busy span is dealt over several; the best of the
    shards' best are the best.
    """
    slide_us, width = us(slide), us(span)
    dealt = _by_span(rows, slide_us, width, [F.col(page).alias("page"), F.pmod(F.xxhash64(page), F.lit(shards)).cast(
        "int").alias("shard")])
    return dealt.groupBy("span", "shard").transformWithState(
        HotPages(n, slide_us, width, us(allowed)), HotPages.ddl, "append", "EventTime")


def last_rankings(rankings: DataFrame, page: str, n: int, slide) -> DataFrame:
    """``(page, window_end, cnt, rank)`` of the last version of every span in a table of :func:`stream_hot_pages`."""
    from eventide.operators.topn import topn_per_window
    last = F.max("version").over(Window.partitionBy("span", "shard"))
    runs = rankings.withColumn("_last", last).where("version = _last")
    ends = F.explode(F.sequence("from_us", "to_us", F.lit(us(slide))))
    rows = runs.select(F.col("page").alias(page), ends.alias("_e"), "cnt")
    return topn_per_window(rows.select(page, from_micros("_e").alias("window_end"), "cnt"), n, page)
