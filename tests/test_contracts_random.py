"""Seeded random streams with one hot key against plain-Python simulations of the
contracts (SURVEY 2.0).  Small bucket widths force many cross-bucket carries."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventide.operators import caps, patterns, reconcile

T0 = dt.datetime(2024, 1, 1)
W = 3_000_000          # 3 s
CW = 7_000_000         # carry width 7 s: many buckets per key


def _ts(us):
    return T0 + dt.timedelta(microseconds=us)


def _us(t):
    return int((t - T0).total_seconds() * 1_000_000)


def _rows(seed, n=600, keys=5, span_s=120, kinds=("a", "b")):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = 0 if rnd.random() < 0.6 else rnd.randrange(1, keys)      # key 0 is hot
        t = rnd.randrange(span_s) * 1_000_000 + rnd.choice([0, 0, 500_000])  # ties on purpose
        out.append((k, rnd.choice(kinds), t, i))
    return out


def _by_key(rows, tie=lambda r: 0):
    g = defaultdict(list)
    for r in rows:
        g[r[0]].append(r)
    return {k: sorted(v, key=lambda r: (r[2], tie(r), r[3])) for k, v in g.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_and_bursts_random(spark, seed):
    rows = _rows(seed, kinds=("fail", "fail", "success"))
    df = spark.createDataFrame([(k, "ip", t, _ts(u), s) for k, t, u, s in rows],
                               "user_id bigint, ip string, event_type string, ts timestamp_ntz, seq bigint")
    exp_pairs, exp_bursts = set(), set()
    for k, seq in _by_key(rows).items():
        last_fail = None
        for _, t, u, _s in seq:
            if t == "fail":
                if last_fail is not None and u - last_fail <= W:
                    exp_pairs.add((k, last_fail, u))
                last_fail = u
            else:
                last_fail = None
        anchor, n, first, last = None, 0, None, None
        for _, t, u, _s in seq:
            if t == "fail":
                if anchor is None or u > anchor + W:
                    if anchor is not None and n >= 2:
                        exp_bursts.add((k, first, last, n))
                    anchor, n, first, last = u, 1, u, u
                else:
                    n, last = n + 1, u
            else:
                if anchor is not None and u > anchor + W and n >= 2:
                    exp_bursts.add((k, first, last, n))
                anchor, n = None, 0
        if anchor is not None and n >= 2:
            exp_bursts.add((k, first, last, n))
    got_pairs = {(r.user_id, _us(r.first_fail_ts), _us(r.last_fail_ts))
                 for r in patterns.failure_pairs(df, W, carry_width=CW).collect()}
    assert got_pairs == exp_pairs
    got_bursts = {(r.user_id, _us(r.first_fail_ts), _us(r.last_fail_ts), r.fail_times)
                  for r in patterns.failure_bursts(df, 2, W, carry_width=CW).collect()}
    assert got_bursts == exp_bursts


@pytest.mark.parametrize("seed", [3, 4])
def test_order_status_random(spark, seed):
    rows = _rows(seed, kinds=("create", "pay"))
    df = spark.createDataFrame([(k, t, "", _ts(u), s) for k, t, u, s in rows],
                               "order_id bigint, event_type string, tx_id string, ts timestamp_ntz, seq bigint")
    exp = set()
    for k, seq in _by_key(rows, tie=lambda r: 0 if r[1] == "create" else 1).items():
        for i, (_, t, u, _s) in enumerate(seq):
            prev = seq[i - 1] if i else None
            nxt = seq[i + 1] if i + 1 < len(seq) else None
            if t == "pay":
                if prev and prev[1] == "create":
                    exp.add((k, "paid" if u - prev[2] < W else "paid_after_timeout"))
                else:
                    exp.add((k, "pay_without_create"))
            elif not (nxt and nxt[1] == "pay"):
                exp.add((k, "created_timeout"))
    out = patterns.order_status(df, W, carry_width=CW)
    got = [(r.order_id, r.status) for r in out.collect()]
    assert set(got) == exp
    n_exp = sum(1 for r in rows if r[1] == "pay") + sum(
        1 for k, seq in _by_key(rows, tie=lambda r: 0 if r[1] == "create" else 1).items()
        for i, r in enumerate(seq) if r[1] == "create" and not (i + 1 < len(seq) and seq[i + 1][1] == "pay"))
    assert len(got) == n_exp


@pytest.mark.parametrize("seed", [5, 6])
def test_reconcile_random(spark, seed):
    rows = _rows(seed, kinds=("P", "R"))
    wl, wr = 5_000_000, 3_000_000
    pays = spark.createDataFrame([(str(k), s, _ts(u), s) for k, t, u, s in rows if t == "P"],
                                 "tx_id string, order_id bigint, ts timestamp_ntz, seq bigint")
    recs = spark.createDataFrame([(str(k), "wechat", _ts(u), s) for k, t, u, s in rows if t == "R"],
                                 "tx_id string, pay_channel string, ts timestamp_ntz, seq bigint")
    exp_m, exp_u = set(), set()
    for k, seq in _by_key(rows, tie=lambda r: 0 if r[1] == "P" else 1).items():
        pending = None
        for _, t, u, s in seq:
            if pending and pending[0] != t and u - pending[1] <= (wl if pending[0] == "P" else wr):
                exp_m.add((str(k), pending[2] if t == "R" else s, s if t == "R" else pending[2]))
                pending = None
            else:
                if pending:
                    exp_u.add((str(k), pending[2]))
                pending = (t, u, s)
        if pending:
            exp_u.add((str(k), pending[2]))
    out = reconcile.reconcile(pays, recs, "tx_id", wl, wr, ["seq"], ["seq"], carry_width=CW)
    got_m = {(r.tx_id, r.left.seq, r.right.seq) for r in out.filter(F.col("tag") == "MATCH").collect()}
    got_u = {(r.tx_id, (r.left or r.right).seq) for r in out.filter(F.col("tag") == "UNMATCHED").collect()}
    assert got_m == exp_m
    assert got_u == exp_u


def test_rate_cap_random(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(500):
        u = 0 if rnd.random() < 0.7 else rnd.randrange(1, 4)
        rows.append((u, rnd.randrange(2), _ts(rnd.randrange(3 * 86_400) * 1_000_000), i))
    df = spark.createDataFrame([(u, a, "p", "c", t, s) for u, a, t, s in rows],
                               "user_id bigint, ad_id bigint, province string, city string, ts timestamp_ntz, seq bigint")
    ranked = caps.rate_cap(df, ["user_id", "ad_id"], 10, "Asia/Shanghai")
    cnt = defaultdict(int)
    exp_pass, exp_warn = set(), set()
    for u, a, t, s in sorted(rows, key=lambda r: (r[2], r[3])):
        day = (t + dt.timedelta(hours=8)).date()
        cnt[(u, a, day)] += 1
        if cnt[(u, a, day)] <= 10:
            exp_pass.add(s)
        elif cnt[(u, a, day)] == 11:
            exp_warn.add(s)
    assert {r.seq for r in caps.cap_passed(ranked, 10).collect()} == exp_pass
    warn_ts = {r.ts for r in caps.cap_warnings(ranked, ["user_id", "ad_id"], 10).collect()}
    assert warn_ts == {rows[s][2] for s in exp_warn}
