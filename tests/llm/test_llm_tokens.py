"""Tokens, packing and matrices: against the tokenizers library, and every id in exactly one place."""

import random
import zlib
from array import array

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from eventide.llm import binary, bpe, packing, tokens

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


def odd_texts(n=1500, seed=1):
    rng = random.Random(seed)
    letters = "aeiouthnsr 'é߀ 漢字́\n\t\x1c\xa0019ABCİΣ!?🎉"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(n)]
    return out + ["", "   ", "a<|endoftext|>b <|startoftext|> c", "don't we'll it's", "é é", "x" * 5000, "12 345,678.90"]


def test_bpe_splits_letters_of_other_unicode_versions_as_the_library():
    tok, own = Tokenizer.from_file(BYTE), bpe.Coder(BYTE)
    assert own.moved    # else the library and ``regex`` know the same version, and nothing is tested
    rng = random.Random(7)
    odd = [chr(c) for c in rng.sample(sorted(own.moved), min(200, len(own.moved)))]
    for _ in range(4000):
        text = rng.choice(odd) + rng.choice(["'s", "'ll", " ", "1", "a", "!"]) + "".join(
            rng.choices(odd + list("'sab1 \n!tllé中") * 9, k=rng.randrange(8)))
        assert list(array("I", own.encode(text))) == tok.encode(text, add_special_tokens=False).ids


def test_bpe_equals_the_library():
    tok, own = Tokenizer.from_file(BYTE), bpe.Coder(BYTE)
    for t in odd_texts():
        want = tok.encode(t, add_special_tokens=False).ids
        got = own.encode(t)
        assert list(array("I", got)) == want
        assert own.decode(got) == tok.decode(want, skip_special_tokens=False)


def test_automaton_on_small_merge_lists():
    """Against merging by priority, on vocabularies with overlapping and repeated-letter merges."""
    rng = random.Random(8)
    for _ in range(150):
        label = {i: bytes([97 + i]) for i in range(3)}
        merges = []
        while len(merges) < 8:
            u, v = rng.choice(list(label)), rng.choice(list(label))
            if label[u] + label[v] not in label.values():
                w = len(label)
                label[w] = label[u] + label[v]
                merges.append((u, v, w))
        machine = bpe.Automaton(label, merges)
        for _ in range(40):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 14)))
            ids = [c - 97 for c in word]
            while True:
                best = min(((k, m) for k, m in enumerate(merges)
                            if any((a, b) == m[:2] for a, b in zip(ids, ids[1:]))), default=None)
                if best is None:
                    break
                u, v, w = best[1]
                out, i = [], 0
                while i < len(ids):
                    if ids[i:i + 2] == [u, v]:
                        out.append(w)
                        i += 2
                    else:
                        out.append(ids[i])
                        i += 1
                ids = out
            assert machine.encode(word) == ids, (word, merges)


def test_chunk_ids_equal_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "GENERATION", 300)     # both generations turn over
    tok, own = Tokenizer.from_file(WORD), tokens.ChunkIds(WORD)
    texts = odd_texts()
    got = own.ids([t.encode() for t in texts])
    assert [list(array("I", g)) for g in got] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("cut", [True, False])
def test_pack_block_keeps_every_id(cut):
    rng = random.Random(3)
    for _ in range(60):
        cap = rng.choice([8, 64, 2048])
        lengths = [rng.randrange(1, cap * 3) if rng.random() < 0.2 else rng.randrange(1, cap) for _ in range(rng.randrange(1, 90))]
        windows = packing.pack_block(lengths, cap, cut)
        assert all(0 < sum(n for _, _, n in w) <= cap for w in windows)
        pieces = sorted(p for w in windows for p in w)
        at = {}
        for i, s, n in pieces:
            assert s == at.get(i, 0)
            at[i] = s + n
        assert at == dict(enumerate(lengths))
        if cut:
            full = sum(n // cap for n in lengths)
            rest = sum(n % cap for n in lengths)
            assert len(windows) == full + -(-rest // cap)


def test_differencing_balances_and_covers():
    rng = random.Random(6)
    sizes = [rng.randrange(1, 1000) for _ in range(200)]
    bins = packing.differencing(sizes, 13)
    assert sorted(i for b in bins for i in b) == list(range(200))
    sums = [sum(sizes[i] for i in b) for b in bins]
    assert len(bins) == 13 and max(sums) - min(sums) < 0.02 * max(sums)


def test_best_fit_takes_the_tightest_row():
    rng = random.Random(7)
    lengths = [rng.randrange(1, 300) for _ in range(300)]
    free, rows = [], []
    for n, i, s in sorted(((min(100, n - s), i, s) for i, n in enumerate(lengths) for s in range(0, n, 100)),
                          key=lambda p: (-p[0], p[1], p[2])):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(100 - n)
            rows.append(n)
    got = binary.best_fit(lengths, 100)
    assert sorted(100 - sum(n for _, _, n in r) for r in got) == sorted(free)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "Gamma!", "δ"]) for _ in range(rng.choice([0, 3, 400, 3000])))) for i in range(60)]
    rows += [(90, None), (91, ""), (None, "no id"), (5, "again"), (5, "again")]
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int").repartition(3).cache()


def ids_of(text):
    return Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids + [1]


def test_pack_round_trip(frame):
    rows = packing.pack(frame, WORD, block=20_000).collect()
    spans = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == spans.get(r.sequence_id, 0) and r.length > 0
        spans[r.sequence_id] = r.offset + r.length
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    assert max(spans.values()) <= 2048
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.start, bytes(r.ids), r.doc_tokens))
    for r in frame.collect():
        want = array("I", ids_of(r.text)).tobytes()
        parts = sorted(by[r.doc_id])
        if r.doc_id != 5:
            assert b"".join(p for _, p, _ in parts) == want and {n for _, _, n in parts} == {len(want) // 4}
    assert sum(r.length for r in rows) == sum(len(ids_of(r.text)) for r in frame.collect())


def test_matrix_round_trip(frame, spark, tmp_path):
    packed = binary.pack_matrix(frame, WORD, block=20_000)
    binary.write_matrix(packed, str(tmp_path / "m"))
    parts = {}
    for r in spark.read.parquet(str(tmp_path / "m")).collect():
        ids, pos = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.position_ids, "<u4")
        assert len(ids) == len(pos) == 2048 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens:] == binary.PAD).all()
        for a, b, d, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts):
            assert (pos[a:b] == np.arange(b - a)).all()
            parts.setdefault(d, []).append((s, ids[a:b].tolist()))
    for r in frame.collect():
        if r.doc_id != 5:
            assert sum((p for _, p in sorted(parts[r.doc_id])), []) == ids_of(r.text)
    assert len(parts[5]) == 3


def test_encode_decode_rows(frame, spark):
    tok = Tokenizer.from_file(BYTE)
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode_decode(frame, BYTE).collect()), key=str)
    want = []
    for r in frame.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), array("I", ids).tobytes(), r.text or ""))
    assert got == sorted(want, key=str)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_decode(none, BYTE).count() == packing.pack(none, WORD).count() == 0
    assert binary.pack_matrix(none, WORD).count() == 0
