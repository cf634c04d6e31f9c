"""Failure bursts (O-37) in one pass over time buckets, with composable summaries.

A burst machine remembers one thing between two events: the failure that
anchors the open burst, or none.  So what a time bucket of a key does to the
machine is a function from the anchor on entering to the anchor on leaving, and
that function is a step function of ``anchor + within``: it has a step at each
failure of the bucket's first ``within`` (before its first success) and nowhere
else, because all entering anchors that lie out of reach of a failure meet in
it.  Three sorted passes, none of which holds a group of rows:

1. per ``(key, bucket)`` the step function, from one walk that carries all
   entering classes at once (classes whose anchors meet go on as one);
2. per key the buckets in order: each function is applied to the anchor that
   entered.  Only the current anchor is held;
3. per ``(key, bucket)`` the machine itself, begun with the anchor that entered.
   Bursts inside a bucket are final; those that cross its edges leave a piece
   in each bucket, and pieces of one anchor are added up.

Four shuffles at any length of the chains, no job while the query is built.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField

from eventide.functions.time import micros
from eventide.operators.passes import same, sorted_pass
from eventide.operators.scan import time_bucket

EVER = 2 ** 63 - 1      # above every instant


class _Steps:
    """The step function of one bucket, built event by event.

    Class ``i`` stands for the entering anchors with ``bounds[i-1] <= anchor +
    within < bounds[i]`` (no anchor counts as the least).  ``chains`` holds the
    classes by their present anchor, earliest first.
    """

    def __init__(self, start: int, within: int):
        self.reach, self.within = start + within, within
        self.bounds: list[int] = []
        self.chains: deque = deque()
        self.free: list[int] = []       # classes without an open burst
        self.waiting = True             # whether some entering anchors have met nothing yet

    def failure(self, at: int, seq) -> None:
        met, self.free = self.free, []
        while self.chains and self.chains[0][0] + self.within < at:
            more = self.chains.popleft()[2]
            if len(more) > len(met):
                met, more = more, met
            met.extend(more)
        if self.waiting:
            if not self.bounds or self.bounds[-1] < at:
                met.append(len(self.bounds))
                self.bounds.append(at)
            self.waiting = at < self.reach
        if met:
            self.chains.append((at, seq, met))

    def other(self) -> None:
        """No burst outlives a success: every class is free, and the same from here on."""
        self.bounds, self.chains, self.free, self.waiting = [EVER], deque(), [0], False

    def result(self) -> tuple[list, list, list]:
        """Bounds of the classes and their leaving anchors; anchors past the last bound leave as they came."""
        leave: list = [None] * len(self.bounds)
        for at, seq, classes in self.chains:
            for i in classes:
                leave[i] = (at, seq)
        last = len(leave) - 1
        keep = [i for i, v in enumerate(leave) if i == last or leave[i + 1] != v]
        if not self.waiting:
            self.bounds[-1] = EVER
        return ([self.bounds[i] for i in keep], [leave[i] and leave[i][0] for i in keep],
                [leave[i] and leave[i][1] for i in keep])


def _steps(within: int, width: int) -> Callable:
    def walk(rows):
        key = bucket = steps = None
        for k, b, fail, at, seq in rows:
            if steps is None or b != bucket or not same(k, key):
                if steps is not None:
                    yield (key, bucket, *steps.result())
                key, bucket, steps = k, b, _Steps(b * width, within)
            if fail:
                steps.failure(at, seq)
            else:
                steps.other()
        if steps is not None:
            yield (key, bucket, *steps.result())

    return walk


def _fold(within: int) -> Callable:
    def walk(rows):
        key, anchor, first = None, None, True
        for k, b, bounds, leave, leave_seq in rows:
            if first or not same(k, key):
                key, anchor, first = k, None, False
            if anchor is not None:
                yield (k, b, *anchor)
            i = 0 if anchor is None else bisect_right(bounds, anchor[0] + within)
            if i < len(bounds):
                anchor = None if leave[i] is None else (leave[i], leave_seq[i])

    return walk


class _Burst:
    """The open burst of a bucket: its anchor, its failures here and whether it began here."""

    __slots__ = ("at", "seq", "n", "last", "own")

    def __init__(self, at: int, seq, own: bool):
        self.at, self.seq, self.own = at, seq, own
        self.n, self.last = (1, at) if own else (0, None)

    def piece(self, dropped: bool) -> tuple:
        return self.at, self.seq, self.n, self.last, dropped


def _pieces(n: int, within: int) -> Callable:
    def walk(rows):
        key = bucket = burst = None
        for k, b, kind, at, seq, fail in rows:
            if b != bucket or not same(k, key):
                if burst is not None and burst.n:
                    yield (key, *burst.piece(False))
                key, bucket, burst = k, b, None
            if not kind:                                    # the anchor that entered
                burst = _Burst(at, seq, False)
                continue
            inside = burst is not None and at <= burst.at + within
            if fail and inside:
                burst.n, burst.last = burst.n + 1, at
                continue
            if burst is not None:
                dropped = inside                            # a success inside
                if burst.n >= n and not dropped if burst.own else burst.n or dropped:
                    yield (key, *burst.piece(dropped))
            burst = _Burst(at, seq, True) if fail else None
        if burst is not None and burst.n:
            yield (key, *burst.piece(False))

    return walk


def anchored_bursts(events: DataFrame, n: int, within_us: int, key: str, fail: str, width_us: int) -> DataFrame:
    """``(key, first_us, last_us, n)`` of the bursts of :func:`eventide.operators.patterns.failure_bursts`."""
    of_key, of_seq = events.schema[key], events.schema["seq"]
    at = micros("ts")
    d = events.where("ts is not null").select(
        F.col(key).alias("k"), time_bucket(at, width_us).alias("b"),
        F.coalesce(F.col("event_type") == fail, F.lit(False)).alias("fail"), at.alias("us"), "seq")
    k, b = StructField("k", of_key.dataType), StructField("b", LongType())
    seq_t, us_t = of_seq.dataType, LongType()

    steps = sorted_pass(d, ["k", "b"], ["us", "seq"], _steps(within_us, width_us), [
        k, b, StructField("bounds", ArrayType(us_t)), StructField("leave", ArrayType(us_t)),
        StructField("leave_seq", ArrayType(seq_t))])
    entered = sorted_pass(steps, ["k"], ["b"], _fold(within_us), [
        k, b, StructField("us", us_t), StructField("seq", seq_t)])
    both = d.select("k", "b", F.lit(1).alias("kind"), "us", "seq", "fail").unionByName(
        entered.select("k", "b", F.lit(0).alias("kind"), "us", "seq", F.lit(True).alias("fail")))
    pieces = sorted_pass(both, ["k", "b"], ["kind", "us", "seq"], _pieces(n, within_us), [
        k, StructField("at", us_t), StructField("seq", seq_t), StructField("n", us_t), StructField("last", us_t),
        StructField("dropped", BooleanType())])
    whole = pieces.groupBy("k", "at", "seq").agg(F.sum("n").alias("n"), F.max("last").alias("last"),
                                                 F.max("dropped").alias("dropped"))
    return whole.where((F.col("n") >= n) & ~F.col("dropped")).select(
        F.col("k").alias(key), F.col("at").alias("first_us"), F.col("last").alias("last_us"), "n")
