"""Packing documents into training windows by Karmarkar-Karp multiway differencing.

Tokens never move between machines: every task tokenizes its own rows and packs
them in blocks of about ``BLOCK`` tokens.  A document longer than a window gives
full windows and a rest; the rests of a block go into the least number of
windows by largest differencing: partial partitions wait in a heap by the gap
between their fullest and emptiest window, and the two with the widest gaps are
merged with the windows of one in rising and of the other in falling order, so
that opposing imbalances cancel.  The near-equal windows may still overhang the
capacity a little; overhanging ends are cut off and laid into windows with
room, and the window count rises where there is none (or, with ``cut=False``,
until nothing overhangs).
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import slices, texts_of
from eventide.llm.tokens import chunk_ids

CAPACITY = 2048
BLOCK = 1 << 20      # tokens packed together: about 512 windows
END = 1              # id that closes every document
READ = 1 << 20       # bytes of text tokenized before packing goes on

Piece = tuple[int, int, int]          # document index, start, length


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Item indices of ``k`` near-equal windows."""
    links: list[tuple[int, int]] = []     # joined nodes: len(sizes) + position
    heap = [(-s, i, np.array([s]), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, s1, n1 = heapq.heappop(heap)
        _, _, s2, n2 = heapq.heappop(heap)
        meet = max(len(s1) + len(s2) - k, 0)
        lone1, lone2 = len(s1) - meet, len(s2) - meet
        joined = np.arange(meet) + len(sizes) + len(links)
        links += zip(n1[lone1:].tolist(), n2[lone2:][::-1].tolist())
        s = np.concatenate([s1[:lone1], s2[:lone2], s1[lone1:] + s2[lone2:][::-1]])
        n = np.concatenate([n1[:lone1], n2[:lone2], joined])
        order = np.argsort(-s, kind="stable")
        s, n = s[order], n[order]
        heapq.heappush(heap, (-int(s[0] - (s[-1] if len(s) == k else 0)), serial, s, n))
        serial += 1
    out: list[list[int]] = []
    for root in heap[0][3].tolist() if heap else []:
        todo, items = [root], []
        while todo:
            x = todo.pop()
            if x < len(sizes):
                items.append(x)
            else:
                todo += links[x - len(sizes)]
        out.append(sorted(items))
    return out


def pack_block(lengths: list[int], capacity: int, cut: bool = True) -> list[list[Piece]]:
    """Windows of pieces that hold every id of documents of these ``lengths`` (each at least 1) once."""
    windows = [[(i, s, capacity)] for i, n in enumerate(lengths) for s in range(0, n - capacity + 1, capacity)]
    rest = [(i, n - n % capacity, n % capacity) for i, n in enumerate(lengths) if n % capacity]
    if not rest:
        return windows
    total = sum(n for _, _, n in rest)
    k = -(-total // capacity)
    while True:
        bins = [[rest[j] for j in b] for b in differencing([n for _, _, n in rest], k)]
        over = max(sum(n for _, _, n in b) for b in bins)
        if cut or over <= capacity:
            break
        k += max(1, k * (over - capacity) // (8 * capacity))
    bins += [[] for _ in range(k - len(bins))]
    spare: list[Piece] = []
    room: list[tuple[int, int]] = []
    for b, items in enumerate(bins):
        used = sum(n for _, _, n in items)
        while used > capacity:
            i, s, n = items.pop()
            off = min(n, used - capacity)
            spare.append((i, s + n - off, off))
            if n > off:
                items.append((i, s, n - off))
            used -= off
        if used < capacity:
            room.append((used - capacity, b))
    heapq.heapify(room)
    for i, s, n in spare:
        while n:
            if not room:
                bins.append([])
                room.append((-capacity, len(bins) - 1))
            free, b = heapq.heappop(room)
            put = min(n, -free)
            bins[b].append((i, s, put))
            if free + put < 0:
                heapq.heappush(room, (free + put, b))
            s, n = s + put, n - put
    return windows + [b for b in bins if b]


def blocks(batches, path: str, end: int, block: int) -> Iterator[tuple[list, list[bytes]]]:
    """(doc ids, little-endian uint32 ids with ``end``) in blocks of about ``block`` tokens."""
    tok, tail = chunk_ids(path), int(end).to_bytes(4, "little")
    keys, ids, total = [], [], 0
    for batch in batches:
        rows = ((key, x) for part in slices(batch, READ) for key, x in zip(
            part.column(0).to_pylist(), tok.ids(texts_of(part))))
        for key, x in rows:
            got = x + tail
            if total and total + len(got) // 4 > block:
                yield keys, ids
                keys, ids, total = [], [], 0
            keys.append(key)
            ids.append(got)
            total += len(got) // 4
    if keys:
        yield keys, ids


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, block: int = BLOCK,
         cut: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset``.

    Every row of ``docs`` (null text: empty) becomes its ids and ``end``; each id
    lies in exactly one piece; a sequence's pieces are gapless from offset 0 and
    hold at most ``capacity`` ids.  Rows with a null doc_id are packed too (null
    doc_id), repeated rows each on their own; an empty table gives no rows.
    Sequence ids are unique: the task's partition and a counter.
    """
    def run(batches):
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        seq = part << 32
        for keys, ids in blocks(batches, tokenizer, end, block):
            cols: list[list] = [[] for _ in range(8)]
            for window in pack_block([len(x) // 4 for x in ids], capacity, cut):
                offset = 0
                for i, s, n in window:
                    raw = ids[i][4 * s:4 * (s + n)]
                    for c, v in zip(cols, (keys[i], s, n, raw, zlib.crc32(raw), len(ids[i]) // 4, seq, offset)):
                        c.append(v)
                    offset += n
                seq += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if j == 3 else pa.int64()) for j, c in enumerate(cols)], names=NAMES)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return src.mapInArrow(run, ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in NAMES))


NAMES = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
