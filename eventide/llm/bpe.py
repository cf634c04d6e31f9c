"""BPE encoding by a tokenization automaton, decoding by its arc labels.

The automaton reads token sequences and accepts exactly those that BPE makes.
It starts with one state and a loop for every byte.  Each merge ``(u, v)``, in
order of priority, adds one gadget: the state reached by ``u`` loses its ``v``
arc (it is copied first if the start or other tokens reach it too), and wherever ``u`` then
``v`` could be read, an arc for the merged token now leads to the state of
``v``.  Where an arc of a merged token starts follows from its left part, so
arcs are kept as what each state has lost and when, not as full rows.

A pre-split word is encoded by running the automaton over it: exactly one path
of arcs spells it, and exactly one spells each prefix that BPE ends a token at.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import PreTokenizer

from eventide.llm.common import slices, texts_of

#: The byte-level pre-split pattern of the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 200_000   # words per Python worker; the table is emptied when full
MEMO = 1 << 20         # arc answers remembered
LONGEST = 64           # longer words are encoded but not remembered
BATCH = 1 << 22        # bytes of text per output batch
KINDS = {r"\p{L}": "a", r"\p{N}": "1", r"[^\s\p{L}\p{N}]": "!"}   # the pattern's classes, a member of each


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def moved_letters(pre: PreTokenizer) -> dict[int, str]:
    """Code points that the vocabulary's pre-tokenizer puts in another class than ``regex`` does, with a member of it.

    The two know different Unicode versions.  A block of one class that the
    pre-tokenizer leaves in one piece agrees; others are tried one by one.
    """
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    moved = {}
    for kind, member in KINDS.items():
        same = "".join(regex.findall(kind + "+", every))
        for lo in range(0, len(same), 256):
            block = same[lo:lo + 256]
            if len(pre.pre_tokenize_str(member + block)) == 1:
                continue
            for c in block:
                into = [m for m in KINDS.values() if len(pre.pre_tokenize_str(m + c)) == 1]
                if into and into[0] != member:
                    moved[ord(c)] = into[0]
    return moved


class Automaton:
    """States, lost arcs and labels, built merge by merge."""

    def __init__(self, label: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.label = label
        self.id_of = {v: k for k, v in label.items()}
        self.state: dict[int, int] = {t: 0 for t, b in label.items() if len(b) == 1}
        self.parts: dict[int, tuple[int, int, int]] = {}      # merged token: left, right, when
        self.lost: list[dict[int, int]] = [{}]                # state: arc -> when it was lost
        reached = {0: len(self.state) + 1}                    # state: tokens that lead to it, and the start
        self.last = len(merges) + 1     # later than any merge
        for when, (u, v, w) in enumerate(merges, 1):
            if u not in self.state or v not in self.state or w in self.state or not self.readable(self.state[u], v):
                continue        # no text ever comes to read u and then v
            q, after = self.state[u], self.state[v]
            if reached[q] > 1 or u == v:    # the merged token goes on as v did before
                reached[q] -= 1
                self.lost.append(dict(self.lost[q]))
                q = self.state[u] = len(self.lost) - 1
                reached[q] = 1
            self.lost[q].setdefault(v, when)
            self.parts[w] = (u, v, when)
            self.state[w] = after if u == v else self.state[v]
            reached[self.state[w]] += 1
        self.longest = max(map(len, label.values()))
        self.arcs: dict[tuple[int, int], bool] = {}

    def readable(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc for ``token`` as built so far."""
        lost, until = self.lost[state], self.last
        while lost.get(token, until + 1) > until:   # a merged token needs its left part's arc when it was added
            if token not in self.parts:
                return True
            token, _, until = self.parts[token]
        return False

    def arc(self, state: int, token: int) -> bool:
        """:meth:`readable` in the finished automaton, remembered."""
        got = self.arcs.get((state, token))
        if got is None:
            if len(self.arcs) >= MEMO:
                self.arcs.clear()
            got = self.arcs[state, token] = self.readable(state, token)
        return got

    def encode(self, word: bytes) -> list[int]:
        """The ids on the one accepting path whose labels spell ``word``.

        Longest labels are tried first; a place in the word is reached by one
        path only, so a place without a way on is never entered again.
        """
        n, at, q, size = len(word), 0, 0, min(len(word), self.longest)
        path: list[tuple[int, int, int, int]] = []
        dead: set[int] = set()
        id_of, state = self.id_of, self.state
        while at < n:
            while size:
                t = id_of.get(word[at:at + size])
                if t is not None and t in state and at + size not in dead and (not at or self.arc(q, t)):
                    break
                size -= 1
            if size:
                path.append((at, q, size, t))
                at, q = at + size, state[t]
                size = min(n - at, self.longest)
            else:
                dead.add(at)
                at, q, size, _ = path.pop()
                size -= 1
        return [t for _, _, _, t in path]


class Coder:
    """Texts to ids and back for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        label = {i: bytes(letters[c] for c in t) for t, i in vocab.items()
                 if all(c in letters for c in t)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        label = {i: b for i, b in label.items() if i not in self.special.values()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.machine = Automaton(label, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.labels = dict(label) | {i: t.encode() for t, i in self.special.items()}
        self.split = regex.compile(SPLIT)
        self.moved = moved_letters(Tokenizer.from_file(path).pre_tokenizer)
        self.odd = frozenset(map(chr, self.moved))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The pre-split words; code points of another class are split as a member of that class would be."""
        if text.isascii() or self.odd.isdisjoint(text):
            return self.split.findall(text)
        return [text[m.start():m.end()] for m in self.split.finditer(text.translate(self.moved))]

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            raw = word.encode("utf-8")
            ids = array("I", self.machine.encode(raw)).tobytes()
            if len(raw) <= LONGEST:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian uint32 ids; special tokens' strings are their ids, as the library has it."""
        if not self.special:
            return b"".join(map(self._word, self.words(text)))
        out = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(array("I", [self.special[part]]).tobytes())
            else:
                out += map(self._word, self.words(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The labels of the ids' arcs in order, as UTF-8 (broken sequences are replaced)."""
        return b"".join(map(self.labels.__getitem__, array("I", ids))).decode("utf-8", "replace")


_loaded: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The worker's coder for ``path``, compiled once."""
    if path not in _loaded:
        _loaded[path] = Coder(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of every row of ``docs``.

    Ids are little-endian uint32.  Null texts are empty (no ids), null doc_ids
    stay null, repeated rows give repeated rows, an empty table none.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        c = coder(vocabulary)
        for batch in batches:
            for part in slices(batch, BATCH):
                ids = [c.encode(t.decode("utf-8")) for t in texts_of(part)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array([c.decode(x) for x in ids], pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
