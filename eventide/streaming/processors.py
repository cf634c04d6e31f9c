"""Keyed state machines for streams (O-33, O-36, O-37, O-38; O-47..O-50).

Spark delivers the rows of one key in a micro-batch unordered and filters
late rows.  ``OrderedKeyProcessor`` therefore buffers rows in list
state and keeps one event-time timer, for the earliest instant something
may be due (an earlier one replaces it); when the watermark passes,
the buffered rows older than the watermark are worked off key by key in ``(ts, tie,
seq)`` order (contract C1) by a small per-key *machine*, whose state lives in
map state.  Machines can also ask for a deadline (a burst closing, a
pending create expiring) so state never outlives its use.

A group of state costs a dozen calls from the Python worker, however few its rows
are.  A group is therefore a shard of the keys, not a key: their number
stays as it is while keys come and go (``SHARDS``).

A hot key is dealt over time buckets by the jobs that only look a bounded time
back or ahead (``by_bucket``), so no group holds a key's whole history; a machine may
also say which rows of a batch can matter to it (``Machine.worth``), as the cap does.

Only the per-key step logic is Python; grouping, state storage (RocksDB
provider), timers and checkpointing are Spark's.
"""

from __future__ import annotations

import datetime as dt
import heapq
from collections import namedtuple
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventide.operators.caps import CAP_MSG
from eventide.operators.patterns import BURST_MSG, PAIR_MSG, STATUS_MSG

US_PER_MS = 1000
SHARDS = 1024       # groups of state that a job's keys are dealt over
CHUNK = 10_000      # rows of an element of the buffer

def _secs(us: int) -> str:
    s = us / 1_000_000
    return str(int(s)) if s == int(s) else str(s)


class Machine:
    """Per-key sequential logic.  ``st`` is a dict persisted between calls."""

    state_ddl: str = ""
    out_ddl: str = ""
    sifts = False       # whether ``worth`` leaves rows out

    def initial(self) -> dict:
        return {}

    def worth(self, rows: Iterator[tuple], fields: list[str], rank, n_keys: int = 0) -> list[tuple]:
        """The rows of a micro-batch that may matter, to be buffered; their first ``n_keys`` fields are the key."""
        return list(rows)

    def step(self, key: tuple, st: dict, row: Row) -> list[tuple]:
        raise NotImplementedError

    def expire(self, key: tuple, st: dict, wm_us: int) -> list[tuple]:
        return []

    def deadline(self, st: dict) -> int | None:
        return None


class OrderStatusMachine(Machine):
    """O-36 (contract C6).  A create waits for the next row of its order.

    Unpaid at ``create + timeout`` it is reported ``created_timeout`` and stays in
    state as told: a pay that comes later takes that report back (``op`` ``-``)
    and is ``paid_after_timeout``, as in a batch.  A told create stays until a row
    of its order follows, or for ``forget`` where that is given; a pay that comes
    still later is then ``pay_without_create``.
    """

    state_ddl = "last string, last_ts long, told boolean"
    out_ddl = "order_id long, status string, tag string, create_us long, pay_us long, msg string, op string"

    def __init__(self, timeout_us: int, forget_us: int | None = None):
        self.t, self.forget = timeout_us, forget_us

    def initial(self):
        return {"last": None, "last_ts": None, "told": None}

    def _out(self, oid, status, c, p, op="+"):
        return (oid, status, "PAY" if status == "paid" else "TIMEOUT", c, p,
                STATUS_MSG[status].format(id=oid), op)

    def step(self, key, st, row):
        oid, out = key[0], []
        if row.event_type == "pay":
            if st["last"] == "create":
                if st["told"]:
                    out.append(self._out(oid, "created_timeout", st["last_ts"], None, "-"))
                ok = row.ts_us - st["last_ts"] < self.t
                out.append(self._out(oid, "paid" if ok else "paid_after_timeout", st["last_ts"], row.ts_us))
            else:
                out.append(self._out(oid, "pay_without_create", None, row.ts_us))
            st.update(self.initial())
        else:
            if st["last"] == "create" and not st["told"]:
                out.append(self._out(oid, "created_timeout", st["last_ts"], None))
            st.update(last="create", last_ts=row.ts_us, told=None)
        return out

    def expire(self, key, st, wm_us):
        out = []
        if st["last"] == "create":
            if not st["told"] and wm_us >= st["last_ts"] + self.t:
                out = [self._out(key[0], "created_timeout", st["last_ts"], None)]
                st["told"] = True
            if st["told"] and self.forget is not None and wm_us >= st["last_ts"] + self.t + self.forget:
                st.update(self.initial())
        return out

    def deadline(self, st):
        if st["last"] != "create":
            return None
        if not st["told"]:
            return st["last_ts"] + self.t
        return None if self.forget is None else st["last_ts"] + self.t + self.forget


class FailurePairsMachine(Machine):
    """O-38: the last failure is kept (replaced by each failure, cleared by success).

    Rows that are not ``home`` come from the bucket before: they report nothing themselves."""

    state_ddl = "last_fail long"
    out_ddl = "user_id long, first_us long, last_us long, fail_times long, warn_msg string"

    def __init__(self, within_us: int, inclusive: bool = True):
        self.w, self.inc = within_us, inclusive

    def initial(self):
        return {"last_fail": None}

    def step(self, key, st, row):
        out = []
        if row.event_type == "fail":
            lf = st["last_fail"]
            if row.home and lf is not None and ((row.ts_us - lf <= self.w) if self.inc else (row.ts_us - lf < self.w)):
                out.append((key[0], lf, row.ts_us, 2, PAIR_MSG.format(user=key[0], secs=_secs(self.w))))
            st["last_fail"] = row.ts_us
        else:
            st["last_fail"] = None
        return out

    def expire(self, key, st, wm_us):
        if st["last_fail"] is not None and wm_us > st["last_fail"] + self.w:
            st["last_fail"] = None   # no later failure can pair with it
        return []

    def deadline(self, st):
        return None if st["last_fail"] is None else st["last_fail"] + self.w + 1


class FailureBurstsMachine(Machine):
    """O-37 (contract C5): anchored bursts, closed when the watermark passes anchor + within."""

    state_ddl = "anchor long, n long, first long, last long"
    out_ddl = "user_id long, first_us long, last_us long, fail_times long, warn_msg string"

    def __init__(self, n: int, within_us: int):
        self.n, self.w = n, within_us

    def initial(self):
        return {"anchor": None, "n": 0, "first": None, "last": None}

    def _close(self, key, st):
        out = []
        if st["anchor"] is not None and st["n"] >= self.n:
            out.append((key[0], st["first"], st["last"], st["n"],
                        BURST_MSG.format(secs=_secs(self.w), n=st["n"])))
        st.update(anchor=None, n=0, first=None, last=None)
        return out

    def step(self, key, st, row):
        a = st["anchor"]
        if row.event_type == "fail":
            if a is None or row.ts_us > a + self.w:
                out = self._close(key, st)
                st.update(anchor=row.ts_us, n=1, first=row.ts_us, last=row.ts_us)
                return out
            st["n"] += 1
            st["last"] = row.ts_us
            return []
        if a is not None and row.ts_us <= a + self.w:
            st.update(anchor=None, n=0, first=None, last=None)      # success inside: discard
            return []
        return self._close(key, st)

    def expire(self, key, st, wm_us):
        if st["anchor"] is not None and wm_us > st["anchor"] + self.w:
            return self._close(key, st)
        return []

    def deadline(self, st):
        return None if st["anchor"] is None else st["anchor"] + self.w + 1


class RateCapMachine(Machine):
    """O-33: first ``n`` rows per key and local day pass, the ``n+1``-th warns."""

    state_ddl = "day string, cnt long"
    out_ddl = ("user_id long, ad_id long, tag string, province string, city string, ts_us long, "
               "seq long, day string, msg string")
    sifts = True

    def __init__(self, n: int, tz: str = "Asia/Shanghai"):
        from zoneinfo import ZoneInfo
        self.n, self.tz = n, ZoneInfo(tz)

    def initial(self):
        return {"day": None, "cnt": 0}

    def worth(self, rows, fields, rank, n_keys=0):
        """The first ``n + 1`` of each key and day: what comes behind them in a batch can neither pass nor warn."""
        day, most, kept = fields.index("click_day"), self.n + 1, {}
        for r in rows:
            of = kept.setdefault((*r[:n_keys], r[day]), [])
            of.append(r)
            if len(of) > 8 * most:
                of[:] = heapq.nsmallest(most, of, key=rank)
        return [r for of in kept.values() for r in heapq.nsmallest(most, of, key=rank)]

    def step(self, key, st, row):
        t = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=row.ts_us)
        day = t.astimezone(self.tz).date().isoformat()
        if st["day"] != day:
            st["day"], st["cnt"] = day, 0
        st["cnt"] += 1
        if st["cnt"] <= self.n:
            return [(key[0], key[1], "PASS", row.province, row.city, row.ts_us, row.seq, day, None)]
        if st["cnt"] == self.n + 1:
            return [(key[0], key[1], "WARN", row.province, row.city, row.ts_us, row.seq, day,
                     CAP_MSG % self.n)]
        return []

    def _day_end(self, day: str) -> int:
        """The first instant after a local day, in epoch microseconds."""
        after = dt.datetime.combine(dt.date.fromisoformat(day) + dt.timedelta(days=1), dt.time(), self.tz)
        return int(after.timestamp()) * 1_000_000

    def expire(self, key, st, wm_us):
        if st["day"] is not None and wm_us >= self._day_end(st["day"]):
            st.update(self.initial())   # no row of that day can still come
        return []

    def deadline(self, st):
        return None if st["day"] is None else self._day_end(st["day"])


def _names(ddl: str) -> list[str]:
    return [f.strip().split(" ")[0] for f in ddl.split(",")]


class FunnelMachine(Machine):
    """O-35 / O-35b: each create is matched with the first pay after it within
    ``within`` (strict); a create times out once the watermark passes
    ``create + within`` without a pay.  One pay may serve several creates (C12)."""

    state_ddl = "pending array<long>"
    out_ddl = "order_id long, tag string, create_us long, pay_us long, timeout_us long"

    def __init__(self, within_us: int):
        self.w = within_us

    def initial(self):
        return {"pending": []}

    def step(self, key, st, row):
        if row.event_type == "create":
            st["pending"].append(row.ts_us)     # in place: the list is this group's own
            return []
        pend = st["pending"]
        out = [(key[0], "PAY", c, row.ts_us, None) for c in pend if row.ts_us - c < self.w]
        out += [(key[0], "TIMEOUT", c, None, c + self.w) for c in pend if row.ts_us - c >= self.w]
        st["pending"] = []
        return out

    def expire(self, key, st, wm_us):
        pend = st["pending"]
        done = [c for c in pend if wm_us >= c + self.w]
        st["pending"] = [c for c in pend if wm_us < c + self.w]
        return [(key[0], "TIMEOUT", c, None, c + self.w) for c in done]

    def deadline(self, st):
        return st["pending"][0] + self.w if st["pending"] else None     # in order


class SequenceMachine(Machine):
    """O-35: sequences of any number of steps; each row has its fit with every step as a bit of ``fits``.

    The buffer holds the times of each sequence under way.  The next row of the
    key either takes it on, ends it (a ``next`` step that does not fit) or lets it
    wait; it ends at the first row's time plus ``within``.  Rows that are not
    ``home`` come from the bucket after and start nothing.
    """

    state_ddl = "pending array<array<bigint>>"

    def __init__(self, names: list[str], follows: list[str], within_us: int, inclusive: bool = False,
                 keys_ddl: str = "user_id long"):
        self.follows, self.w, self.inc = follows, within_us, inclusive
        self.out_ddl = f"{keys_ddl}, tag string, steps int, " + ", ".join(f"{n}_us long" for n in names)

    def initial(self):
        return {"pending": []}

    def _out(self, key, times):
        n = len(self.follows)
        return (key[0], "MATCH" if len(times) == n else "TIMEOUT", len(times), *times, *[None] * (n - len(times)))

    def _late(self, start, now):
        return now - start > self.w if self.inc else now - start >= self.w

    def step(self, key, st, row):
        out, wait = [], []
        for times in st["pending"]:
            i = len(times)
            if self._late(times[0], row.ts_us):
                out.append(self._out(key, times))
            elif row.fits >> i & 1:
                times = [*times, row.ts_us]
                if i + 1 == len(self.follows):
                    out.append(self._out(key, times))
                else:
                    wait.append(times)
            elif self.follows[i] == "next":
                out.append(self._out(key, times))
            else:
                wait.append(times)
        if row.home and row.fits & 1:
            if len(self.follows) == 1:
                out.append(self._out(key, [row.ts_us]))
            else:
                wait.append([row.ts_us])
        st["pending"] = wait
        return out

    def expire(self, key, st, wm_us):
        done = [t for t in st["pending"] if self._late(t[0], wm_us)]
        st["pending"] = [t for t in st["pending"] if not self._late(t[0], wm_us)]
        return [self._out(key, t) for t in done]

    def deadline(self, st):
        return st["pending"][0][0] + self.w if st["pending"] else None      # in order of their first rows


class ReconcileMachine(Machine):
    """O-41 / O-42 (contract C7): one pending row per key; the next row of the
    other side within the pending row's patience pairs with it, a row of the
    same side overwrites it (the overwritten row is unmatched)."""

    state_ddl = "side int, ts_us long, seq long, order_id long, pay_channel string"
    out_ddl = ("tx_id string, tag string, order_id long, pay_us long, pay_seq long, "
               "pay_channel string, receipt_us long, receipt_seq long")

    def __init__(self, wait_left_us: int, wait_right_us: int):
        self.wait = {0: wait_left_us, 1: wait_right_us}

    def initial(self):
        return {"side": None, "ts_us": None, "seq": None, "order_id": None, "pay_channel": None}

    @staticmethod
    def _row(key, tag, p, r):
        return (key[0], tag, p and p["order_id"], p and p["ts_us"], p and p["seq"],
                r and r["pay_channel"], r and r["ts_us"], r and r["seq"])

    def _unmatched(self, key, st):
        pend = dict(st)
        return self._row(key, "UNMATCHED", pend if pend["side"] == 0 else None,
                         pend if pend["side"] == 1 else None)

    def step(self, key, st, row):
        cur = {"side": row.tie, "ts_us": row.ts_us, "seq": row.seq,
               "order_id": row.order_id, "pay_channel": row.pay_channel}
        if st["side"] is not None and st["side"] != cur["side"] \
                and cur["ts_us"] - st["ts_us"] <= self.wait[st["side"]]:
            p, r = (dict(st), cur) if st["side"] == 0 else (cur, dict(st))
            st.update(self.initial())
            return [self._row(key, "MATCH", p, r)]
        out = [self._unmatched(key, st)] if st["side"] is not None else []
        st.update(cur)
        return out

    def expire(self, key, st, wm_us):
        if st["side"] is not None and wm_us > st["ts_us"] + self.wait[st["side"]]:
            out = [self._unmatched(key, st)]
            st.update(self.initial())
            return out
        return []

    def deadline(self, st):
        return None if st["side"] is None else st["ts_us"] + self.wait[st["side"]] + 1


def _lists(v):
    """Arrays of a state as lists, whatever sequence they are read back as."""
    return [_lists(x) for x in v] if isinstance(v, (list, tuple)) else v


class ProcessingTimeCap(StatefulProcessor):
    """O-51: the first ``n`` rows of a key pass, the next warns, until the clock's next reset clears the state.

    The clock is the processing time: a timer at the next local midnight of
    ``tz``, or ``every_ms`` after the key's first row where that is given.
    """

    def __init__(self, n: int, tz: str = "Asia/Shanghai", every_ms: int | None = None):
        self.n, self.tz, self.every = n, tz, every_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cnt = handle.getValueState("cnt", "n long")

    def reset_at(self, now_ms: int) -> int:
        """The instant of the reset that follows ``now_ms``."""
        if self.every is not None:
            return now_ms + self.every
        from zoneinfo import ZoneInfo
        zone = ZoneInfo(self.tz)
        today = dt.datetime.fromtimestamp(now_ms / 1000, zone).date()
        return int(dt.datetime.combine(today + dt.timedelta(days=1), dt.time(), zone).timestamp()) * 1000

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        have = self.cnt.get()[0] if self.cnt.exists() else 0
        if not have:
            self.handle.registerTimer(self.reset_at(timerValues.getCurrentProcessingTimeInMs()))
        out = []
        for r in sorted(rows, key=lambda r: (r.ts_us is not None, r.ts_us, r.seq)):
            have += 1
            if have <= self.n + 1:
                warn = have > self.n
                out.append(Row(user_id=key[0], ad_id=key[1], tag="WARN" if warn else "PASS", ts_us=r.ts_us, seq=r.seq,
                               msg=CAP_MSG % self.n if warn else None))
        self.cnt.update((have,))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.cnt.clear()
        return iter([])

    def close(self) -> None:
        pass


class OrderedKeyProcessor(StatefulProcessor):
    """Buffer the rows of a shard's keys; work each key's off in event-time order when the watermark passes.

    An element of the buffer is an Arrow batch of rows.  Only the keys with rows to
    work off and those whose deadline has come are looked up in the machines' states.
    """

    def __init__(self, machine: Machine, keys: list[str], keys_ddl: str, schema: pa.Schema,
                 order=("ts_us", "tie", "seq")):
        self.machine, self.keys_ddl, self.schema = machine, keys_ddl, schema
        self.n, self.fields = len(keys), schema.names
        self.order = [(c, "ascending") for c in (*keys, *order)]
        self.rank = itemgetter(*[self.fields.index(o, self.n) for o in order])
        self.out_fields = _names(machine.out_ddl)
        self.state_fields = _names(machine.state_ddl)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buffer", "rows binary")
        self.st = handle.getMapState("machine", self.keys_ddl, self.machine.state_ddl)
        self.deadlines = handle.getMapState("deadlines", self.keys_ddl, "us long")
        self.due = handle.getValueState("due", "ms long")
        self.row = namedtuple("Buffered", self.fields[self.n:])

    def _wake(self, ms: int) -> None:
        """Have the shard's one timer fire at ``ms`` or earlier."""
        if self.due.exists():
            (known,) = self.due.get()
            if known <= ms:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    def _table(self, frame) -> pa.Table:
        """Rows as they were before ``run_ordered`` put 0 for the integers that are null."""
        nulls, columns = frame["nulls"].to_numpy(), []
        some = nulls.any()
        for i, f in enumerate(self.schema):
            mask = (nulls >> i & 1).astype(bool) if some and pa.types.is_integer(f.type) else None
            columns.append(pa.array(frame[f.name], f.type, mask, from_pandas=True))
        return pa.Table.from_arrays(columns, schema=self.schema)

    @staticmethod
    def _tuples(table: pa.Table) -> Iterator[tuple]:
        for b in table.to_batches(max_chunksize=CHUNK):
            yield from zip(*(c.to_pylist() for c in b.columns))

    def _worthy(self, tables: Iterator[pa.Table]) -> Iterator[pa.Table]:
        if not self.machine.sifts:
            return tables
        rows = self.machine.worth(chain.from_iterable(map(self._tuples, tables)), self.fields, self.rank, self.n)
        return iter([pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), self.schema)],
                                          schema=self.schema)] if rows else [])

    def _append(self, table: pa.Table) -> None:
        for b in table.combine_chunks().to_batches(max_chunksize=CHUNK):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.schema) as w:
                w.write_batch(b)
            self.buf.appendValue((sink.getvalue().to_pybytes(),))

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        first = []
        for t in self._worthy(map(self._table, rows)):
            if t.num_rows:
                self._append(t)
                first.append(pc.min(t["ts_us"]).as_py())
        if first:
            self._wake(min(first) // US_PER_MS + 1)
        return iter([])

    def _saved(self, key: tuple) -> dict | None:
        v = self.st.getValue(key)
        return None if v is None else {f: _lists(x) for f, x in zip(self.state_fields, tuple(v))}

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        wm_ms = timerValues.getCurrentWatermarkInMs()
        wm_us, n, m = wm_ms * US_PER_MS, self.n, self.machine
        parts = [pa.ipc.open_stream(bytes(r[0])).read_all() for r in self.buf.get()] if self.buf.exists() else []
        every = pa.concat_tables([self.schema.empty_table(), *parts])
        now = pc.less(every["ts_us"], wm_us)
        rest, ready = every.filter(pc.invert(now)), every.filter(now).sort_by(self.order)
        if ready.num_rows:
            self.buf.clear()
            self._append(rest)
        waits = {tuple(k): v[0] for k, v in self.deadlines.iterator()} if self.deadlines.exists() else {}
        over = {k for k, us in waits.items() if us // US_PER_MS + 1 <= wm_ms}
        out, kept = [], self.st.exists()

        def work(k: tuple, rows) -> None:
            saved = self._saved(k) if kept else None
            st = m.initial() if saved is None else saved
            for r in rows:
                out.extend(m.step(k, st, self.row._make(r[n:])))
            out.extend(m.expire(k, st, wm_us))
            dl = m.deadline(st)
            if dl is not None or any(v not in (None, 0, []) for v in st.values()):
                self.st.updateValue(k, tuple(st[f] for f in self.state_fields))
            elif saved is not None:
                self.st.removeKey(k)
            if dl != waits.get(k):
                if dl is None:
                    self.deadlines.removeKey(k)
                else:
                    self.deadlines.updateValue(k, (dl,))
            waits[k] = dl

        for k, rows in groupby(self._tuples(ready), key=itemgetter(slice(n))):
            over.discard(k)
            work(k, rows)
        for k in over:
            work(k, ())
        due = [us for us in waits.values() if us is not None]
        if rest.num_rows:
            due.append(pc.min(rest["ts_us"]).as_py())
        if due:
            self._wake(min(due) // US_PER_MS + 1)
        # as objects: integers with nulls among them stay exact
        return iter([pd.DataFrame(out, columns=self.out_fields, dtype=object)] if out else [])

    def close(self) -> None:
        pass


def by_bucket(df: DataFrame, width_us: int, back_us: int = 0, ahead_us: int = 0, halo: Column | None = None) -> DataFrame:
    """``df`` dealt over time buckets of ``width_us`` (column ``bucket``), with ``home`` false on copies.

    Rows of ``halo`` (default: all) are copied into every bucket that lies within
    ``back_us`` before or ``ahead_us`` after them, as ``scan.bounded_prev`` does: whoever
    looks no farther finds in a row's own bucket what it would find in the whole
    key.  Rows without a time have no bucket and go.
    """
    def at(us: Column) -> Column:
        return F.floor(us / F.lit(width_us)).cast("bigint")

    t = F.col("ts_us")
    wide = F.lit(True) if halo is None else halo
    first = at(F.when(wide, t - F.lit(back_us)).otherwise(t))
    last = at(F.when(wide, t + F.lit(ahead_us)).otherwise(t))
    return df.withColumn("bucket", F.explode(F.sequence(first, last))) \
        .withColumn("home", F.col("bucket") == at(t))


def run_ordered(df: DataFrame, keys: list[str], machine: Machine, in_cols: list[str],
                in_ddl: str, shards: int = SHARDS) -> DataFrame:
    """Apply a machine per key with ``transformWithStateInPandas`` in event-time mode.

    ``df`` must carry a watermark (``with_event_time``) and the ``ts_us``,
    ``tie`` and ``seq`` columns used for ordering; rows without a time go.  The keys
    are dealt over ``shards`` groups of state by their hash; a checkpoint belongs to its number.
    """
    keys_ddl = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = to_arrow_schema(StructType([df.schema[k] for k in keys] + StructType.fromDDL(in_ddl).fields))
    schema = pa.schema([f.with_nullable(True) for f in schema])
    # pandas would read integers with nulls among them as floats: such nulls go as bits of a column of their own
    nulls, columns = F.lit(0).cast("long"), []
    for i, f in enumerate(schema):
        whole = pa.types.is_integer(f.type)
        columns.append(F.coalesce(f.name, F.lit(0).cast(df.schema[f.name].dataType)).alias(f.name) if whole else f.name)
        if whole:
            nulls = nulls + F.col(f.name).isNull().cast("long") * (1 << i)
    shard = F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("int").alias("shard")
    rows = df.where("ts_us is not null").select(*columns, nulls.alias("nulls"), "event_time", shard)
    return rows.groupBy("shard").transformWithStateInPandas(
        OrderedKeyProcessor(machine, keys, keys_ddl, schema), machine.out_ddl, "append", "EventTime")
