"""Packed id matrices: best-fit-decreasing with a segment tree over free space.

Tasks tokenize and pack their own rows in blocks, as in :mod:`packing`.  A
document longer than a row of the matrix is split losslessly; the parts go,
longest first, into the open row with the least sufficient space, found by
descending a segment tree that counts the open rows of each free size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.packing import BLOCK, CAPACITY, END, Piece, blocks

PAD = 0


class FreeSpace:
    """Open rows by free size; ``take(n)`` gives one with the least size that holds ``n``."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def put(self, size: int, row: int) -> None:
        self.rows.setdefault(size, []).append(row)
        self._add(size, 1)

    def _add(self, size: int, by: int) -> None:
        at = size + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        at = n + self.leaves
        while not self.count[at]:       # climb to the first subtree on the right with an open row
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        size = at - self.leaves
        self._add(size, -1)
        return size, self.rows[size].pop()


def best_fit(lengths: list[int], capacity: int) -> list[list[Piece]]:
    """Rows of pieces that hold every id of documents of these ``lengths`` once."""
    parts = [(min(capacity, n - s), i, s) for i, n in enumerate(lengths) for s in range(0, n, capacity)]
    parts.sort(key=lambda p: (-p[0], p[1], p[2]))
    rows: list[list[Piece]] = []
    free = FreeSpace(capacity)
    for n, i, s in parts:
        size, row = free.take(n) or (capacity, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append((i, s, n))
        if size > n:
            free.put(size - n, row)
    return rows


SCHEMA = ("sequence_id long, ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, "
          "starts array<long>, n_tokens int")


def pack_matrix(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END,
                block: int = BLOCK) -> DataFrame:
    """One row per row of the matrix: ``sequence_id, ids, position_ids, cu_seqlens, doc_ids, starts, n_tokens``.

    ``ids`` and ``position_ids`` are ``capacity`` little-endian uint32 each, padded
    with ``PAD``; positions restart at 0 at every segment and run on over the
    padding as a segment of its own.  ``cu_seqlens`` starts with 0 and ends with
    ``n_tokens``; segment j holds the ids of ``doc_ids[j]`` from ``starts[j]`` on.
    Null texts are empty (only the ``end`` id), null doc_ids stay null, repeated
    rows are packed each, an empty table gives no rows.
    """
    def run(batches):
        seq = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        for keys, ids in blocks(batches, tokenizer, end, block):
            flat = [np.frombuffer(x, "<u4") for x in ids]
            rows = best_fit([len(x) for x in flat], capacity)
            for lo in range(0, len(rows), 256):
                out: list[list] = [[] for _ in range(7)]
                for row in rows[lo:lo + 256]:
                    used = sum(n for _, _, n in row)
                    matrix = np.full(capacity, PAD, "<u4")
                    matrix[:used] = np.concatenate([flat[i][s:s + n] for i, s, n in row])
                    cuts = np.cumsum([0] + [n for _, _, n in row])
                    size = np.diff(np.r_[cuts, capacity])
                    position = (np.arange(capacity) - np.repeat(np.r_[cuts[:-1], used], size)).astype("<u4")
                    for c, v in zip(out, (seq, matrix.tobytes(), position.tobytes(), cuts.tolist(),
                                          [keys[i] for i, _, _ in row], [s for _, s, _ in row], used)):
                        c.append(v)
                    seq += 1
                types = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()),
                         pa.list_(pa.int64()), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types)], names=[f.split()[0] for f in SCHEMA.split(", ")])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return src.mapInArrow(run, SCHEMA)


def write_matrix(packed: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet shards (binary id and position columns)."""
    packed.write.mode("errorifexists").parquet(path)
