"""Sequence patterns and keyed state machines, as batch plans (O-35..O-39).

All operators order each key's events by ``(ts, tie, seq)`` (contract C1) and
read neighbours / running values through ``keyed_scan``, which never gathers a
whole key into one task.  Bounds follow contract C4: failure pairs use an
inclusive bound, strict patterns and the order time-out a strict one; every
function takes ``inclusive=``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import from_micros, micros, ts_text
from eventide.operators.bursts import anchored_bursts
from eventide.operators.scan import (Running, bounded_next_min, bounded_prev, keyed_scan,
                                     time_bucket)
from eventide.operators.windows import us

HOUR_US = 3_600_000_000

# ---- fixed values: result and alert texts of the reference ---------------
PAIR_MSG = "{user} login fail 2 times in {secs} seconds."
PATTERN_MSG = "login fail LoginEvent({user},{ip},{type},{ts_s})"
BURST_MSG = "login fail in {secs}s for {n} times."
FUNNEL_PAID_MSG = "order {id} start at {start} and payed at {pay}"
FUNNEL_TIMEOUT_MSG = "order {id} start at {start} and timeout at {timeout}"
STATUS_MSG = {
    "paid": "[{id}] payed successfully",
    "paid_after_timeout": "[{id}] payed but already timeout",
    "pay_without_create": "[{id}] payed but not found create",
    "created_timeout": "[{id}] created, order timeout",
}
# ---------------------------------------------------------------------------


def _within(gap_us: Column, bound_us: int, inclusive: bool) -> Column:
    return gap_us <= F.lit(bound_us) if inclusive else gap_us < F.lit(bound_us)


def _fmt(template: str, **cols: Column) -> Column:
    """``format_string`` from a ``{name}`` template (all arguments as text)."""
    order = []
    pattern = template
    while "{" in pattern:
        i = pattern.index("{")
        j = pattern.index("}", i)
        order.append(pattern[i + 1:j])
        pattern = pattern[:i] + "%s" + pattern[j + 1:]
    return F.format_string(pattern, *[cols[n].cast("string") for n in order])


def _secs_text(bound_us: int) -> str:
    s = bound_us / 1_000_000
    return str(int(s)) if s == int(s) else str(s)


def failure_pairs(logins: DataFrame, within, inclusive: bool = True, key: str = "user_id",
                  fail: str = "fail", carry_width=HOUR_US) -> DataFrame:
    """O-38: two consecutive failures of a key within ``within``.

    The reference keeps the last failure and replaces it on every failure, and
    clears it on success, so the kept failure is always the previous event
    when that was a failure.  Output: key, first_fail_ts, last_fail_ts,
    fail_times (2), warn_msg.
    """
    w_us = us(within)
    sc = bounded_prev(logins, [key], ["ts", "seq"], micros("ts"), w_us, ["event_type", "ts"],
                      us(carry_width))
    hit = sc.filter((F.col("event_type") == fail) & (F.col("prev_event_type") == fail)
                    & _within(F.col("prev_gap_us"), w_us, inclusive))
    return hit.select(key, F.col("prev_ts").alias("first_fail_ts"), F.col("ts").alias("last_fail_ts"),
                      F.lit(2).cast("bigint").alias("fail_times"),
                      _fmt(PAIR_MSG, user=F.col(key), secs=F.lit(_secs_text(w_us))).alias("warn_msg"))


def failure_pattern(logins: DataFrame, within, inclusive: bool = False, key: str = "user_id",
                    fail: str = "fail", carry_width=HOUR_US) -> DataFrame:
    """O-39 (O-35 strict): ``begin(fail).next(fail).within(t)``.

    Strict contiguity: the second failure is the very next event.  Every start
    row makes its own match.  Output as ``failure_pairs`` with the first
    event rendered in the message.
    """
    w_us = us(within)
    sc = bounded_prev(logins, [key], ["ts", "seq"], micros("ts"), w_us, ["event_type", "ts", "ip"],
                      us(carry_width))
    hit = sc.filter((F.col("event_type") == fail) & (F.col("prev_event_type") == fail)
                    & _within(F.col("prev_gap_us"), w_us, inclusive))
    ts_s = (micros("prev_ts") - F.pmod(micros("prev_ts"), F.lit(1_000_000))) / F.lit(1_000_000)
    msg = _fmt(PATTERN_MSG, user=F.col(key), ip=F.col("prev_ip"), type=F.col("prev_event_type"),
               ts_s=ts_s.cast("bigint"))
    return hit.select(key, F.col("prev_ts").alias("first_fail_ts"), F.col("ts").alias("last_fail_ts"),
                      F.lit(2).cast("bigint").alias("fail_times"), msg.alias("warn_msg"))


@dataclass(frozen=True)
class Step:
    """One step of a sequence: its name, what a row must be, and how it follows the step before.

    ``follows``: ``next`` (the very next row of the key) or ``followedBy`` (the
    first such row later on, whatever lies between).
    """

    name: str
    where: Column
    follows: str = "followedBy"


def match_sequence(df: DataFrame, keys: list[str], steps: list[Step], within, inclusive: bool = False,
                   ts: str = "ts", seq: str = "seq", carry_width=HOUR_US) -> DataFrame:
    """O-35 / O-35b / O-39: sequences of any number of steps with a bound from the first row.

    Every row that is the first step starts one sequence; each later step takes
    the first row that fits after the step before.  The steps are resolved from
    the last backwards: a row's continuation is the neighbour's (``next``) or
    the first fitting later row's (``followedBy``, a suffix minimum), which
    carries its own continuation along.  Output: keys, ``tag`` (``MATCH``, or
    ``TIMEOUT`` when a step is missing or beyond the bound), ``steps`` reached
    in time, and ``<name>_ts`` of each reached step (null beyond).
    """
    w_us = us(within)
    order = [ts, seq]
    cur = df.where(F.col(ts).isNotNull()).select(
        *keys, *order, *[F.coalesce(s.where, F.lit(False)).alias(f"_s{i}") for i, s in enumerate(steps)])
    times: list = []
    rest = None
    for i in range(len(steps) - 1, 0, -1):
        own = F.struct(*[F.col(c).alias(f"o{j}") for j, c in enumerate(order)],
                       *([F.col("_m").alias("m")] if rest else []))
        cur = cur.withColumn("_c", F.when(F.col(f"_s{i}"), own)).drop("_m")
        bucket = time_bucket(micros(ts), us(carry_width))
        if steps[i].follows == "next":
            cur = keyed_scan(cur, keys, order, bucket, next=["_c"]).withColumnRenamed("next__c", "_m")
        else:
            cur = keyed_scan(cur, keys, order, bucket, running=[
                Running("_m", F.col("_c"), "min", "suffix", inclusive=False)])
        cur, rest = cur.drop("_c", f"_s{i}"), True
    path, ok, reached = "_m", F.lit(True), F.lit(1)
    for s in steps[1:]:
        t = F.col(f"{path}.o0")
        ok = ok & t.isNotNull() & _within(micros(t) - micros(ts), w_us, inclusive)
        ok = F.coalesce(ok, F.lit(False))
        reached = reached + ok.cast("int")
        times.append(F.when(ok, t).alias(f"{s.name}_ts"))
        path += ".m"
    return cur.filter(F.col("_s0")).select(
        *keys, F.when(ok, F.lit("MATCH")).otherwise(F.lit("TIMEOUT")).alias("tag"), reached.alias("steps"),
        F.col(ts).alias(f"{steps[0].name}_ts"), *times)


def _order_tie(event_type: str = "event_type", first: str = "create") -> Column:
    return F.when(F.col(event_type) == first, F.lit(0)).otherwise(F.lit(1))


def order_funnel(orders: DataFrame, within, inclusive: bool = False, key: str = "order_id",
                 start: str = "create", follow: str = "pay", carry_width=HOUR_US
                 ) -> DataFrame:
    """O-35 / O-35b: ``begin(create).followedBy(pay).within(t)`` with time-outs.

    Relaxed contiguity: each create is matched with the first pay after it
    (other events may sit between; one pay may serve several creates, C12).
    The next pay per row is a suffix minimum over a forward halo
    (``bounded_next_min``): exact for every pay within the bound.  Output rows
    carry ``tag``: ``PAY`` for matches (pay_ts set), ``TIMEOUT`` for creates
    without a pay in time (timeout_ts = create + within).
    """
    w_us = us(within)
    d = orders.withColumn("_tie", _order_tie("event_type", start))
    nxt = F.when(F.col("event_type") == follow, F.struct(F.col("ts").alias("ts"),
                                                          F.col("_tie").alias("tie"),
                                                          F.col("seq").alias("seq")))
    # only a pay within the bound matters, so a forward halo replaces the full scan
    sc = bounded_next_min(d, [key], ["ts", "_tie", "seq"], micros("ts"), w_us, "_next_pay", nxt,
                          us(carry_width))
    starts = sc.filter(F.col("event_type") == start)
    pay_ts = F.col("_next_pay.ts")
    ok = pay_ts.isNotNull() & _within(micros(pay_ts) - micros("ts"), w_us, inclusive)
    timeout_ts = from_micros(micros("ts") + F.lit(w_us))
    tag = F.when(ok, F.lit("PAY")).otherwise(F.lit("TIMEOUT"))
    start_txt = ts_text(F.col("ts"))
    msg = F.when(ok, _fmt(FUNNEL_PAID_MSG, id=F.col(key), start=start_txt, pay=ts_text(pay_ts))) \
           .otherwise(_fmt(FUNNEL_TIMEOUT_MSG, id=F.col(key), start=start_txt,
                           timeout=ts_text(timeout_ts)))
    return starts.select(key, tag.alias("tag"), F.col("ts").alias("create_ts"),
                         F.when(ok, pay_ts).alias("pay_ts"),
                         F.when(~ok, timeout_ts).alias("timeout_ts"), msg.alias("msg"))


def order_status(orders: DataFrame, timeout, inclusive: bool = False, key: str = "order_id",
                 create: str = "create", pay: str = "pay", carry_width=HOUR_US) -> DataFrame:
    """O-36: the create/pay state machine that tolerates a pay before its create (C6).

    Per order in ``(ts, create before pay, seq)`` order:

    * a pay right after a create: ``paid`` if ``pay < create + timeout``,
      else ``paid_after_timeout``;
    * any other pay: ``pay_without_create``;
    * a create not right before a pay: ``created_timeout``.

    Output: key, status, tag (``PAY`` main output, ``TIMEOUT`` side output),
    create_ts, pay_ts, msg.
    """
    t_us = us(timeout)
    d = orders.withColumn("_tie", _order_tie("event_type", create))
    sc = keyed_scan(d, [key], ["ts", "_tie", "seq"], time_bucket(micros("ts"), us(carry_width)),
                    prev=["event_type", "ts"], next=["event_type"])
    is_pay, is_create = F.col("event_type") == pay, F.col("event_type") == create
    after_create = F.col("prev_event_type") == create
    in_time = _within(micros("ts") - micros("prev_ts"), t_us, inclusive)
    status = (F.when(is_pay & after_create & in_time, F.lit("paid"))
              .when(is_pay & after_create, F.lit("paid_after_timeout"))
              .when(is_pay, F.lit("pay_without_create"))
              .when(is_create & ~F.coalesce(F.col("next_event_type") == pay, F.lit(False)),
                    F.lit("created_timeout")))
    out = sc.withColumn("status", status).filter(F.col("status").isNotNull())
    msg = F.col("status")
    for k, tmpl in STATUS_MSG.items():
        msg = F.when(F.col("status") == k, _fmt(tmpl, id=F.col(key))).otherwise(msg)
    return out.select(
        key, "status",
        F.when(F.col("status") == "paid", F.lit("PAY")).otherwise(F.lit("TIMEOUT")).alias("tag"),
        F.when(is_create, F.col("ts")).when(after_create, F.col("prev_ts")).alias("create_ts"),
        F.when(is_pay, F.col("ts")).alias("pay_ts"),
        msg.alias("msg"))


def failure_bursts(logins: DataFrame, n: int, within, key: str = "user_id", fail: str = "fail",
                   carry_width=None) -> DataFrame:
    """O-37: bursts of at least ``n`` failures within ``within`` of the first (C5).

    The first failure anchors a burst; failures up to ``anchor + within``
    (inclusive) join it; any other event in that span discards it (also one
    without a type); otherwise it is reported when ``count >= n``.  The next
    failure anchors anew.  A null key is a key like any other; events without a
    time are left out.

    Plan: ``bursts.anchored_bursts``.  ``carry_width`` is the width of its time
    buckets (16 times ``within`` by default); results do not depend on it.
    Output: key, first_fail_ts, last_fail_ts, fail_times, warn_msg.
    """
    w_us = us(within)
    width = us(carry_width) if carry_width is not None else max(16 * w_us, 1_000_000)
    b = anchored_bursts(logins, n, w_us, key, fail, width)
    return b.select(key, from_micros("first_us").alias("first_fail_ts"), from_micros("last_us").alias("last_fail_ts"),
                    F.col("n").alias("fail_times"),
                    _fmt(BURST_MSG, secs=F.lit(_secs_text(w_us)), n=F.col("n")).alias("warn_msg"))
