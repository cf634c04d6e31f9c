"""SimHash, substring, exact and vector dedup against brute force, with planted and odd cases."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import components, exact, simhash, substring, vectors

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def corpus(n=160, seed=3):
    """Random texts over few words, with copies, near copies, shared passages, nulls and repeated rows."""
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(40)] + ["É", "ß", "a", "A", "the"]
    passage = [rng.choice(vocab) for _ in range(70)]
    out = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 5, 49, 50, 51, 120, 300]))]
        kind = rng.random()
        if kind < 0.3 and out:
            words = (rng.choice(out)[1] or "").split()
            if kind < 0.15 and words:
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(vocab)
        elif kind < 0.5:
            at = rng.randrange(len(words) + 1)
            words = words[:at] + passage[rng.randrange(10):60 + rng.randrange(10)] + words[at:]
        elif kind < 0.55:
            words = ["x"] * rng.choice([50, 90])
        text = rng.choice([" ", "  ", "\t", "\n"]).join(words)
        out.append((1000 - 3 * i if i % 7 else 5000 + i, text.upper() if rng.random() < 0.05 else text))
    return out + [(2, None), (3, ""), (4, " \n"), (None, out[0][1]), out[1], out[1]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "x", i) for i, r in enumerate(corpus())]
    return spark.createDataFrame(rows, "doc_id long, text string, gone_id string, mark long").repartition(3).cache()


def closure(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def brute_fingerprint(text):
    words = (text or "").encode().translate(LOWER).split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


@pytest.mark.parametrize("max_bits", [0, 1, 3, 5])
def test_gray_links_of_a_shared_block(spark, max_bits):
    """Fingerprints that share their leading bits, some of them near: no link is lost however often they are dealt."""
    rng = random.Random(11)
    fps = {rng.getrandbits(48) | 0xABCD << 48 for _ in range(150)}
    for x in list(fps)[:60]:
        for bit in rng.sample(range(64), rng.randrange(1, 7)):
            x ^= 1 << bit
        fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    reps = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, rep long")
    lab = list(range(len(fps)))

    def root(i):
        while lab[i] != i:
            i = lab[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = sorted((root(i), root(j)))
                lab[b] = a
    want = {i: root(i) for i in range(len(fps))}
    links = [tuple(r) for r in simhash.gray_links(reps, max_bits, cell=8).collect()]
    lab = list(range(len(fps)))
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        lab[b] = a
    assert {i: root(i) for i in range(len(fps))} == want


@pytest.mark.parametrize("cell", [simhash.CELL, 4])
def test_simhash_against_all_pairs(spark, docs, cell, monkeypatch):
    monkeypatch.setattr(simhash.gray_links, "__defaults__", (cell,))
    rows = sorted(((r.doc_id, brute_fingerprint(r.text)) for r in docs.collect() if r.doc_id is not None))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 3
             or rows[i][0] == rows[j][0] and rows[i][1] == rows[j][1]]
    want = sorted((d, f, rows[t][0]) for (d, f), t in zip(rows, closure(len(rows), links)))
    got = sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()
                 if r.doc_id is not None)
    assert got == want
    stays = simhash.drop_near_duplicates(docs)
    assert stays.columns == docs.columns
    assert sorted(r.doc_id for r in stays.collect() if r.doc_id is not None) == [d for d, _, c in want if d == c]


def test_gray_tree_finds_every_pair():
    rng = np.random.default_rng(1)
    for n in (1, 2, 9, 70, 900):
        base = rng.integers(0, 2**63, 5, dtype=np.uint64)
        fp = base[rng.integers(0, 5, n)]
        for _ in range(4):
            fp = fp ^ (rng.integers(0, 2, n).astype(np.uint64) << rng.integers(0, 64, n).astype(np.uint64))
        fp = np.unique(fp)
        fp = fp[np.argsort(simhash.gray_rank(fp))]
        a, b = simhash.tree_links(fp, 3)
        want = {(i, j) for j in range(len(fp)) for i in range(j) if int(fp[i] ^ fp[j]).bit_count() <= 3}
        assert set(zip(a.tolist(), b.tolist())) == want


def test_gray_tree_of_many_leads_opens_few_pairs():
    """Links under equal leads only, found by opening a small part of all pairs."""
    rng = np.random.default_rng(2)
    fp = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    fp = np.unique(np.r_[fp, fp[:500] ^ np.uint64(1 << 40), fp[:300] ^ np.uint64(5 << 50)])
    for bits in (16, 6, 0):
        lead = fp & np.uint64((1 << bits) - 1)
        order = simhash.gray_order(lead, fp)
        by_rank = sorted(range(len(fp)), key=lambda i: gray_place(int(lead[i]) << 64 | int(fp[i])))
        assert order.tolist() == by_rank
        g, h = lead[order], fp[order]
        a, b = simhash.tree_links(h, 3, g)
        i, j = np.triu_indices(len(h), 1)
        near = (np.bitwise_count(h[i] ^ h[j]) <= 3) & (g[i] == g[j])
        assert set(zip(a.tolist(), b.tolist())) == set(zip(i[near].tolist(), j[near].tolist()))
        opened = sum(len(a) for a, _ in simhash.node_pairs(h, 3, g))
        assert opened < len(i) / (100 if bits == 16 else 4)


def gray_place(code):
    rank = 0
    while code:
        rank ^= code
        code >>= 1
    return rank


def test_gray_rank_as_a_column(spark):
    codes = [0, 1, 2, 3, 0xABCD, 0x3FFFF, 0x20000]
    rows = spark.createDataFrame([(c,) for c in codes], "c long").select("c", simhash.rank_of(F.col("c"), 18).alias("r"))
    assert {r.c: r.r for r in rows.collect()} == {c: gray_place(c) for c in codes}


def test_components_on_paths_stars_and_cycles(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(50)] + [(300, 301), (301, 302), (302, 300)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    top = closure(1300, real)
    assert got == {n: top[n] for link in real for n in link}


def brute_substring(rows, k):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        if d is not None:
            for i in range(len(w) - k + 1):
                key = tuple(w[i:i + k])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        if d is not None:
            for i in range(len(w) - k + 1):
                if first[tuple(w[i:i + k])] < d:
                    gone.update(range(i, i + k))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d is None, d, len(w), len(gone), kept.decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [substring.SLICE, 16])
def test_substring_against_all_windows(docs, size, monkeypatch):
    want = brute_substring([(r.doc_id, r.text) for r in docs.collect()], 50)
    # slices of a document reach the workers by their arguments, so they are checked here
    monkeypatch.setattr(substring, "SLICE", size)
    texts = [(r.text or "").encode() for r in docs.collect()]
    doc, first, n, _, _ = substring.pieces_of(texts, 50)
    seen = sorted((d, w) for d, f, k in zip(doc.tolist(), first.tolist(), n.tolist()) for w in range(f, f + k))
    assert seen == [(i, w) for i, t in enumerate(texts) for w in range(len(t.split()) - 49)]
    got = sorted(((r.doc_id is None, r.doc_id, r.n_words, r.n_removed, r.kept_text)
                  for r in substring.drop_repeats(docs).collect()), key=str)
    assert got == want


def test_equal_windows_file_alike():
    """A window's symbol does not depend on what surrounds it, nor on slices."""
    rng = random.Random(2)
    for trial in range(60):
        vocab = [b"%d" % i for i in range(rng.choice([1, 2, 3, 30]))]
        core = [rng.choice(vocab) for _ in range(50)]
        docs = [b" ".join([rng.choice(vocab) for _ in range(rng.randrange(60))] + core
                          + [rng.choice(vocab) for _ in range(rng.randrange(60))]) for _ in range(3)]
        doc, first, n, key, _ = substring.pieces_of(docs, 50)
        at = {(d, w): k for d, f, m, k in zip(doc, first, n, key) for w in range(f, f + m)}
        split = [d.split() for d in docs]
        same = {}
        for (d, w), k in at.items():
            assert same.setdefault(tuple(split[d][w:w + 50]), k) == k


def brute_exact(rows):
    norm = [(d, (t or "").encode().translate(LOWER)) for d, t in rows]
    out = []
    for d, t in norm:
        group = [x for x, u in norm if u == t]
        top = max((x for x in group if x is not None), default=None)
        out.append((d, top, len(group), d == top, hashlib.sha256(t).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits,capacity", [(64, 1 << 20), (64, 4), (3, 2), (3, 1)])
def test_exact_groups_with_and_without_collisions(docs, bits, capacity):
    want = brute_exact([(r.doc_id, r.text) for r in docs.collect()])
    got = sorted(map(tuple, exact.exact_groups(docs, capacity, bits).collect()), key=str)
    assert got == want


@pytest.mark.parametrize("held,capacity", [(1, 4), (3000, 64), (3000, 1), (3000, 5000)])
def test_directory_doubles_until_no_bucket_is_overfull(spark, held, capacity):
    depth = (held // capacity).bit_length() + exact.SPARE
    entries = spark.range(held).select(F.xxhash64("id").alias("key"))
    slots = {r.slot: r.bucket for r in exact.directory(entries, capacity, depth).collect()}
    keys = [r.key & (1 << 64) - 1 for r in entries.collect()]

    def full(d, prefix):
        return sum(k >> 64 - d == prefix for k in keys) > capacity
    held_by = {}
    for k in keys:
        bucket = slots[k >> 64 - depth]
        d = bucket.bit_length() - 1
        assert bucket == 1 << d | k >> 64 - d
        held_by.setdefault(bucket, []).append(k)
    assert all(len(v) <= capacity or b >= 1 << depth for b, v in held_by.items())
    for b in list(held_by)[:20]:
        d = b.bit_length() - 1
        assert d == 0 or full(d - 1, (b ^ 1 << d) >> 1)   # half as deep would have been overfull


@pytest.mark.parametrize("part", [1 << 14, 20])
def test_exact_parts_follow_rows_not_shuffle_partitions(spark, docs, part, monkeypatch):
    """Each file that a task writes costs its executor some processes."""
    files, keep = {}, exact.keep
    monkeypatch.setattr(exact, "FILE_ROWS", part, raising=False)

    def counted(df, label):
        out = keep(df, label)
        files[label] = len(out.inputFiles())
        return out
    monkeypatch.setattr(exact, "keep", counted)
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = exact.exact_groups(docs, 4)
        got, parts = sorted(map(tuple, out.collect()), key=str), out.rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == brute_exact([(r.doc_id, r.text) for r in docs.collect()])
    links = len({r[4] for r in got})
    assert files.pop("exact-rows") <= 3 and files["exact-index"] <= links // part + 1
    assert sum(files.values()) <= (links + (links << exact.SPARE)) // part + 2
    assert parts == len(got) // part + 1


def test_exact_drop_keeps_columns(docs):
    stays = exact.drop_exact_duplicates(docs)
    want = [r for r in brute_exact([(r.doc_id, r.text) for r in docs.collect()]) if r[3] or r[0] is None]
    assert stays.columns == docs.columns and stays.count() == len(want)


def vector_rows():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 16))
    rows = [b + 0.05 * rng.standard_normal(16) * rng.random() * 4 for b in np.repeat(base[:20], 8, axis=0)]
    rows += list(base) + [rows[0]] * 5 + [rows[3] * 1e-30, rows[3] * 1e30]
    out = [(i * 2, [float(x) for x in v]) for i, v in enumerate(rows)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    return out + [(1 + 2 * i, b) for i, b in enumerate(bad)]


@pytest.mark.parametrize("cell", [vectors.CELL, 3])
def test_vectors_against_all_pairs(spark, cell, monkeypatch):
    monkeypatch.setattr(vectors.vector_links, "__defaults__", (cell,))
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<double>, rep long")
    good = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    unit = {i: (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max()) for i, v in good}
    links = [(a, b) for a in unit for b in unit
             if a < b and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= 0.95]
    top = closure(max(i for i, _ in rows) + 1, links)
    degree = dict.fromkeys((i for i, _ in rows), 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()}
    assert got == {i: (degree[i], top[i], top[i] == i) for i, _ in rows}


def test_vector_recall_is_designed_for_the_threshold():
    rng = np.random.default_rng(9)
    bits, bands = vectors.shape_of(1_000_000, 0.95)
    rot = vectors.Rotation(64, bits, bands)
    a = vectors.unit(rng.standard_normal((3000, 64)))
    b = rng.standard_normal((3000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * vectors.unit(b)
    assert (rot.band_values(a) == rot.band_values(b)).any(axis=1).mean() > 0.995


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert simhash.near_duplicates(none).count() == 0
    assert substring.drop_repeats(none).count() == 0
    assert exact.exact_groups(none).count() == 0
    assert exact.drop_exact_duplicates(none).columns == none.columns
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
