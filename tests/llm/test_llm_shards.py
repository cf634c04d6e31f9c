"""Suffix dedup, the divergence audit and the prefix trie against brute force, with odd cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventide.llm import divergence, suffixes, trie


# ---- suffix dedup ---------------------------------------------------------

def brute_bytes(rows, length):
    """(doc_id, text) rows -> sorted (doc_id, n_bytes, n_removed, n_spans, kept); distinct doc_ids or equal rows."""
    seen, out = {}, {}
    docs = {(d, t or "") for d, t in rows if d is not None}
    for d, t in sorted(docs):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if seen.setdefault(w, (d, i)) < (d, i):
                gone[i:i + length] = True
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
        out[d, t] = len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g)
    whole = lambda t: (len(t.encode()), 0, 0, t.encode())
    return sorted(((-1 if d is None else d), *(out[d, t or ""] if d is not None else whole(t or ""))) for d, t in rows)


def got_bytes(df, length):
    out = suffixes.drop_repeated_bytes(df, length).collect()
    return sorted(((-1 if r[0] is None else r[0]), r[1], r[2], r[3], bytes(r[4])) for r in out)


def byte_corpus(n=120, seed=5):
    rng = random.Random(seed)
    alphabet = "ab é\x00\n"
    passage = "".join(rng.choice("abcdefgh é") for _ in range(90))
    out = []
    for i in range(n):
        text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 19, 20, 21, 60, 200])))
        kind = rng.random()
        if kind < 0.3 and out:
            text = rng.choice(out)[1]
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", "x", "yz"]) + text[at:]
        elif kind < 0.6:
            a, b = sorted(rng.sample(range(91), 2))
            text = text[:30] + passage[a:b] + text[30:]
        elif kind < 0.7:
            text = rng.choice(["a", "ab", "abc", "é", "-=-="]) * rng.choice([10, 30, 80])
        out.append((1000 - 3 * i if i % 7 else 5000 + i, text))
    return out + [(2, None), (3, ""), (None, out[0][1]), (None, None), out[1], out[1]]


@pytest.mark.parametrize("length", [20, 7])
def test_suffix_dedup_equals_brute_force(spark, length):
    rows = byte_corpus()
    df = spark.createDataFrame([(*r, "x", 1, b"y") for r in rows],
                               "doc_id long, text string, gone string, mark int, body binary").repartition(3)
    assert got_bytes(df, length) == brute_bytes(rows, length)


def test_suffix_dedup_over_many_buckets_and_hot_groups(spark):
    """One text in half of the rows and one passage in the rest: groups reach over bucket edges."""
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(150))
    rows = [(i, passage if i % 2 else f"{i} {passage} {rng.random()}") for i in range(400)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert got_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 100) == brute_bytes(rows, 100)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_suffix_dedup_long_text_and_empty_table(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300_000))
    rows = [(1, long[:200_000]), (2, long), (3, "=" * 50_000), (4, long[100_000:100_150])]
    assert got_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 100) == brute_bytes(rows, 100)
    assert got_bytes(spark.createDataFrame([], "doc_id long, text string"), 100) == []


def test_rows_that_share_a_doc_id_are_taken_by_their_text(spark):
    a, b = "x" + "abcdefghij" * 3, "y" + "abcdefghij" * 3
    got = got_bytes(spark.createDataFrame([(1, a), (1, b), (2, a)], "doc_id long, text string"), 20)
    by_id = defaultdict(list)
    for d, size, gone, *_ in got:
        by_id[d].append(gone)
    # within one text the period of ten repeats; of the two texts of id 1 one also repeats the other
    assert by_id[2] == [31] and sorted(by_id[1]) == [20, 30]


def test_multikey_order_is_the_sorted_order():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    tie = rng.integers(0, 5, 500)
    order, same = suffixes.multikey_order(keys, [tie])
    want = sorted(range(500), key=lambda i: (*keys[i].tolist(), tie[i]))
    assert [(*keys[i], tie[i]) for i in order] == [(*keys[i], tie[i]) for i in want]
    assert same.tolist() == [False] + [keys[a].tolist() == keys[b].tolist() for a, b in zip(order, order[1:])]


# ---- divergence audit -----------------------------------------------------

def brute_audit(rows, least=10, top=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held, count = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = Counter(term.findall((text or "").translate(fold)))
        count[lang or "", source or ""].update(words)
        held[lang or ""].update(words.keys())
    out = []
    for lang in held:
        kept = [t for t, d in held[lang].items() if d >= least]
        groups = {s: c for (g, s), c in count.items() if g == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}
        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(items[:most], 1)]
    return sorted(out)


def audit_corpus(n=400, seed=6, sources=7):
    rng = random.Random(seed)
    vocab = ["w" + "abcdefghij"[i % 10] * (i // 10 + 1) for i in range(90)] + ["É", "straße", "ＡＢ", "日本", "İx"]
    out = []
    for i in range(n):
        own = vocab[i % sources * 7:][:40]
        words = [rng.choice(own) for _ in range(rng.choice([0, 1, 5, 40]))]
        text = rng.choice([" ", "--", "1", "_", "\n"]).join(words)
        out.append((text.upper() if rng.random() < 0.1 and text.isascii() else text, rng.choice(["en", "de", None]),
                    rng.choice([f"s{i % sources}", None, ""])))
    return out + [(None, "fr", "a"), ("", "fr", "b"), ("only", "fr", "a"), (None, None, None), out[0], out[0]]


@pytest.mark.parametrize("sizes", [(32, 512), (2, 8)])
def test_audit_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(divergence, "GROUPS", sizes[0])
    monkeypatch.setattr(divergence, "TERMS", sizes[1])
    rows = audit_corpus()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                               "text string, lang string, source string, n int, term string, at int").repartition(4)
    assert sorted(map(tuple, divergence.audit(df).collect())) == brute_audit(rows)


def test_audit_without_terms_and_rows(spark):
    df = spark.createDataFrame([("a b", "en", "x"), (None, "en", "y")], "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(df).collect())) == [
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert divergence.audit(df.limit(0)).collect() == []


def test_audit_long_text(spark):
    rows = [("wort " * 400_000, "de", "x")] + [("wort baum", "de", "y")] * 12
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(df).collect())) == brute_audit(rows)


def test_joint_walk_prices_every_column_once():
    rng = np.random.default_rng(3)
    for rows, cols in ((1, 1), (5, 9), (6, 40)):
        n = rng.integers(0, 5, (rows, cols)) * (rng.random((rows, cols)) < 0.3)
        p, zero = n * 100 + 7 + np.arange(rows)[:, None], 7 + np.arange(rows)
        height = int(max(rows, cols) - 1).bit_length()
        r, c = np.nonzero(n)
        tree = divergence.QuadTree(r, c, p[r, c], height)
        for same in (True, False):
            full, empty = divergence.joint_prices(tree, tree, zero, zero, cols, height, same)
            for i in range(rows):
                for j in range(i + 1 if same else 0, rows):
                    both = (n[i] == 0) & (n[j] == 0)
                    assert empty[i, j] == both.sum()
                    assert full[i, j] == sum(divergence.price(p[i], p[j])[~both])


# ---- conversation prefix trie ---------------------------------------------

def brute_trie(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t, r or "", x or ""))
    key = lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(
        f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).digest())
    own = {c: [(r, x) for _, r, x in sorted(ts, key=key)] for c, ts in by.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += (len(m) - 1) * words
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def talk(n=300, seed=9):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        if c % 20 == 0 and rng.random() < 0.3:
            continue    # no conversation to take the first turns from
        kind = rng.random()
        for t in range(rng.choice([1, 2, 3, 6])):
            text = "same old turn" if kind < 0.4 else rng.choice(["a", "a b", "", None, "c\x0bd e", "É  f"])
            out.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", None, "bot"]) if kind > 0.4 else "user", text))
    return out + [(None, 1, "user", "x"), out[0], out[0]]


def got_trie(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 8, 37])
def test_trie_equals_brute_force(spark, parts):
    rows = talk()
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], str(parts))
        spark.conf.set(keys[1], "false")
        df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                   "conv_id long, turn int, role string, text string, path string, shard int").repartition(5)
        assert got_trie(trie.conversation_trie(df)) == brute_trie(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_trie_of_nothing_and_of_a_long_talk(spark):
    schema = "conv_id long, turn int, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    rows = [(c, t, "u", f"{t % 5} w" if t else "y " * 500_000) for c in (20, 21, 27) for t in range(400)]
    assert got_trie(trie.conversation_trie(spark.createDataFrame(rows, schema))) == brute_trie(rows)


def test_findclose_delimits_subtrees():
    rng = random.Random(1)
    paths = sorted([bytes([rng.randrange(3)]) for _ in range(rng.randrange(9))] for _ in range(700))
    tree, owner, last = trie.encode(paths)
    stack, close = [], {}
    for i, b in enumerate(tree.bits.tolist()):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    assert [close[i] for i in tree.opens.tolist()] == tree.closes.tolist()
    assert [tree.depth[n] for n in last] == [len(p) for p in paths]
