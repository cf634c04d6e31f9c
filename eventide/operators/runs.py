"""Top-n per window from runs of windows with constant counts (O-34b), without listing the windows.

A run is ``(span, from_us, to_us, key, cnt)``: the key counts ``cnt`` in every
window whose end lies on the slide's grid from ``from_us`` to ``to_us``, all in
one span.  Between two instants at which some run begins or ends, the ranking
stands still.  A sweep walks a span's runs in order of their beginnings, holds
those that are open, sorted by rank, and puts out how long each place is held.
Spans are dealt over shards of keys first; the best of the shards' best are the
best, so a second sweep ranks those.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from eventide.functions.time import from_micros
from eventide.operators.passes import sorted_pass
from eventide.operators.windows import us

SHARDS = 8      # groups of keys that a span is dealt over


class _Places:
    """The open runs of one group, and who has held each of the ``n`` places since when."""

    def __init__(self, n: int, slide: int):
        self.n, self.slide = n, slide
        self.open: list[tuple] = []     # (-cnt, whether the key is not null, key): the order of the ranks
        self.ends: list[tuple] = []
        self.held: list = [None] * n    # (entry, since)
        self.now = None

    def _settle(self, at: int) -> Iterator[tuple]:
        for i in range(self.n):
            entry, was = self.open[i] if i < len(self.open) else None, self.held[i]
            if was is None or was[0] != entry:
                if was is not None:
                    yield was[1], at - self.slide, was[0][2], -was[0][0], i + 1
                self.held[i] = None if entry is None else (entry, at)

    def _close(self, at: int) -> None:
        while self.ends and self.ends[0][0] == at:
            entry = heapq.heappop(self.ends)[1]
            del self.open[bisect_left(self.open, entry)]

    def advance(self, to: int | None) -> Iterator[tuple]:
        """What is settled before instant ``to`` (None: the end of the group)."""
        if to is not None and to == self.now:
            return
        if self.now is not None:
            yield from self._settle(self.now)
        while self.ends and (to is None or self.ends[0][0] < to):
            at = self.ends[0][0]
            self._close(at)
            yield from self._settle(at)
        if to is not None:
            self._close(to)
        self.now = to

    def add(self, to: int, key, cnt: int) -> None:
        entry = (-cnt, key is not None, key)
        insort(self.open, entry)
        heapq.heappush(self.ends, (to + self.slide, entry))


def _sweep(n: int, slide: int, groups: int) -> Callable:
    """Walk of rows ``(*group, from, to, key, cnt)``; its rows are ``(*group, from, to, key, cnt, rank)``."""
    def walk(rows):
        group, places = None, None
        for r in rows:
            if places is None or r[:groups] != group:
                if places is not None:
                    yield from ((*group, *x) for x in places.advance(None))
                group, places = r[:groups], _Places(n, slide)
            yield from ((*group, *x) for x in places.advance(r[groups]))
            places.add(*r[groups + 1:])
        if places is not None:
            yield from ((*group, *x) for x in places.advance(None))

    return walk


def topn_of_runs(runs: DataFrame, key: str, n: int, slide, shards: int = SHARDS) -> DataFrame:
    """``(span, from_us, to_us, key, cnt, rank)``: the runs of the ``n`` best places of every window.

    Ranks by count descending, then key ascending (a null key first).  A group of
    the first sweep holds the open runs of a shard of keys, one of the second at
    most ``n`` per shard.
    """
    slide_us, long = us(slide), LongType()
    cols = ["from_us", "to_us", "key", "cnt"]
    fields = [StructField("from_us", long), StructField("to_us", long), StructField("key", runs.schema[key].dataType),
              StructField("cnt", long), StructField("rank", long)]
    span = StructField("span", long)
    d = runs.select("span", F.pmod(F.xxhash64(key), F.lit(shards)).alias("shard"), "from_us", "to_us",
                    F.col(key).alias("key"), "cnt")
    best = sorted_pass(d, ["span", "shard"], cols, _sweep(n, slide_us, 2), [span, StructField("shard", long), *fields])
    best = sorted_pass(best.select("span", *cols), ["span"], cols, _sweep(n, slide_us, 1), [span, *fields])
    return best.withColumnRenamed("key", key)


def windows_of_runs(runs: DataFrame, slide) -> DataFrame:
    """One row per window of each run, with ``window_end`` in place of the run's ends and span."""
    rest = [c for c in runs.columns if c not in ("span", "from_us", "to_us")]
    wins = runs.select(*rest, F.explode(F.sequence("from_us", "to_us", F.lit(us(slide)))).alias("_w"))
    return wins.select(*rest, from_micros("_w").alias("window_end"))
