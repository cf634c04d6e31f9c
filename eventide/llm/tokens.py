"""Token ids of whole texts with a public tokenizer, remembered chunk by chunk.

The word-level vocabulary drops white space before it merges anything, so a
text's ids are the ids of its white-space-separated chunks, in order.  Chunks
recur, so each task remembers the ids of the chunks it has met (a bounded
table) and gives only new ones to the tokenizer.
"""

from __future__ import annotations

import json
import os
from array import array

import regex
from tokenizers import Tokenizer

from eventide.llm.bpe import byte_letters

GENERATION = 400_000   # chunks per generation of the table; two generations live at once
MARKS = frozenset(".,!?;:")
LONGEST = 64           # longer chunks are encoded but not remembered
#: The pre-split pattern of the word-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


class ChunkIds:
    """Little-endian uint32 ids of texts.

    Chunks of plain Latin letters, digits and punctuation need no Unicode
    normalisation but lower-casing, so they are split here and their pieces go
    straight to the tokenizer's model; any other chunk takes the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        first = {t[0] for t in self.special}
        self.mark = first.pop() if len(first) == 1 else ""      # no special token without this character
        splits = [p["pattern"]["Regex"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())
                  if p["type"] == "Split"]
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", ())]
        self.direct = splits == [SPLIT] and steps == ["NFC", "Replace", "Lowercase"]
        self.split = regex.compile(SPLIT)
        self.letters = {b: c for c, b in byte_letters().items()}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            mapped = piece if piece.isalpha() and piece.isascii() else piece.encode().decode("latin-1").translate(
                self.letters)
            ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            if len(self.pieces) >= GENERATION:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def learn(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        found, rest = {}, []
        for c in chunks:
            s = c.decode("utf-8")
            if self.direct and (s.isascii() or max(s) < "\u0130") and (
                    self.mark not in s or not any(t in s for t in self.special)):
                s = s.lower()
                if s.isalpha():
                    found[c] = self._piece(s)
                elif s[-1] in MARKS and s[:-1].isalpha():
                    found[c] = self._piece(s[:-1]) + self._piece(s[-1])
                else:
                    found[c] = b"".join(map(self._piece, self.split.findall(s)))
            else:
                rest.append(c)
        for lo in range(0, len(rest), 4096):
            part = rest[lo:lo + 4096]
            for c, e in zip(part, self.tok.encode_batch_fast([c.decode("utf-8") for c in part],
                                                             add_special_tokens=False)):
                found[c] = array("I", e.ids).tobytes()
        return found

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; chunks not met before are learnt."""
        out = []
        for t in texts:
            chunks = t.split()
            ids = list(map(self.young.get, chunks))
            gaps = [k for k, i in enumerate(ids) if i is None]
            if gaps:
                new = {chunks[k] for k in gaps}
                own = {c: self.old[c] for c in new if c in self.old}
                own.update(self.learn([c for c in new if c not in own]))
                for k in gaps:
                    ids[k] = own[chunks[k]]
                self.young.update(own if max(map(len, own)) <= LONGEST else
                                  {c: i for c, i in own.items() if len(c) <= LONGEST})
                if len(self.young) > GENERATION:
                    self.old, self.young = self.young, {}
            out.append(b"".join(ids))
        return out


_loaded: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    """The worker's tokenizer for ``path``, loaded once."""
    if path not in _loaded:
        _loaded[path] = ChunkIds(path)
    return _loaded[path]
