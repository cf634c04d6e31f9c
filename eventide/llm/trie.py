"""Conversation prefix trie in balanced parentheses, one encoding per shard.

Conversations are sorted by their turns and range-partitioned (equal ones by
id, so that a conversation a third of all rows repeat is cut into several
shards).  Each shard writes its trie as a sequence of parentheses, one pair per
node in preorder, with a tree of the least excess of blocks of it.  ``findclose``
over that tree delimits every subtree; the rank of ``()`` pairs counts its
leaves, and cumulative arrays over the preorder give its members and savings.

Nodes on the path of a shard's first or last conversation (its spines) may
continue in the neighbouring shards.  A shard returns them as two rows with what hangs
off each node; one task merges the spines of all shards (two rows a shard,
however many conversations) with the same trie, and hands the merged nodes'
members back to their children.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import keep_only

SPINE = 20       # a conversation takes its first turns from the one at the multiple of SPINE at or below its id
HEAD = 4         # and at most HEAD - 1 of them
RUN = 64         # parentheses of a block of the excess tree
PIECE = 4096     # ids in one piece of a list of ends
NONE = np.iinfo(np.int64).max    # no id yet


class Parentheses:
    """A trie of sorted paths as balanced parentheses with a range min-max tree over the excess."""

    def __init__(self, shared: np.ndarray, length: np.ndarray):
        """``shared[i]``: turns that path ``i`` has in common with path ``i - 1``; ``length[i]``: its turns.

        Node 0 is the root, then nodes in preorder.
        """
        new = length - shared
        before = np.r_[0, length[:-1]] if len(length) else length
        closing = before - shared                      # nodes that end before path i opens its own
        size = int(new.sum()) + 1
        bits = np.zeros(2 * size, bool)
        self.opens = np.empty(size, np.int64)
        self.opens[0] = 0
        step = np.cumsum(closing + new)
        start = 1 + step - new
        self.opens[1:] = np.repeat(start - np.cumsum(new) + new, new) + np.arange(size - 1)
        bits[self.opens] = True
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1))
        self.depth = self.excess[self.opens] - 1
        pad = np.concatenate([self.excess, np.full(-len(bits) % RUN, self.excess.max())])
        self.levels = [pad.reshape(-1, RUN).min(1)]    # least excess of blocks, of pairs of blocks, ...
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            low = np.r_[low, np.full(len(low) % 2, low.max())]
            self.levels.append(low.reshape(-1, 2).min(1))
        leaf = bits & ~np.r_[bits[1:], True]
        self.leaf_rank = np.r_[0, np.cumsum(leaf)]
        self.closes = self.findclose(self.opens)
        self.span = (self.closes - self.opens + 1) // 2

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one at ``at``: the next place where the excess is one less."""
        goal = self.excess[at] - 1
        out = np.full(len(at), -1)
        self._scan(at + 1, goal, out, np.arange(len(at)))
        # climb to the first block on the right whose least excess reaches the goal
        open_ = np.flatnonzero(out < 0)
        node, want = at[open_] // RUN, goal[open_]
        level = np.zeros(len(open_), np.int64)
        found = np.full(len(open_), -1)
        live = np.arange(len(open_))
        for k, low in enumerate(self.levels):
            right = node[live] + 1
            hit = (node[live] % 2 == 0) & (right < len(low))
            hit[hit] = low[right[hit]] <= want[live][hit]
            if k == len(self.levels) - 1:
                hit[:] = False
            found[live[hit]] = right[hit]
            level[live[hit]] = k
            live = live[~hit]
            node[live] //= 2
        # and down to the block itself
        for k in range(len(self.levels) - 2, -1, -1):
            down = np.flatnonzero((level > k) & (found >= 0))
            left = found[down] * 2
            found[down] = np.where(self.levels[k][left] <= want[down], left, left + 1)
            level[down] = k
        self._scan(found * RUN, want, out, open_)
        return out

    def _scan(self, start: np.ndarray, goal: np.ndarray, out: np.ndarray, index: np.ndarray) -> None:
        """The first place in the rest of each start's block with the goal's excess."""
        place, live = start.copy(), np.arange(len(start))
        stop = np.minimum((start // RUN + 1) * RUN, len(self.excess))
        while len(live):
            live = live[place[live] < stop[live]]
            hit = self.excess[place[live]] == goal[live]
            out[index[live[hit]]] = place[live[hit]]
            live = live[~hit]
            place[live] += 1

    def leaves(self) -> np.ndarray:
        """Childless nodes of each subtree."""
        return self.leaf_rank[self.closes + 1] - self.leaf_rank[self.opens]

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Each subtree's sum of a value per node."""
        total = np.r_[0, np.cumsum(value)]
        first = np.arange(len(value))
        return total[first + self.span] - total[first]

    def parents(self) -> np.ndarray:
        """The preorder number of each node's parent (-1 for the root)."""
        out = np.full(len(self.depth), -1)
        path: list[int] = []
        for i, d in enumerate(self.depth.tolist()):
            del path[d:]
            if path:
                out[i] = path[-1]
            path.append(i)
        return out


def least_in(value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of ``value[lo:hi]`` for each (non-empty) range, by doubling."""
    table = [value]
    while 2 << (len(table) - 1) <= len(value):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    step = np.floor(np.log2(hi - lo)).astype(np.int64)
    out = np.empty(len(lo), np.int64)
    for k in np.unique(step):
        at = step == k
        out[at] = np.minimum(table[k][lo[at]], table[k][hi[at] - (1 << int(k))])
    return out


def shared_turns(paths: list[list[bytes]]) -> np.ndarray:
    """Turns each path has in common with the one before it."""
    out = np.zeros(len(paths), np.int64)
    for i in range(1, len(paths)):
        a, b = paths[i - 1], paths[i]
        n, most = 0, min(len(a), len(b))
        while n < most and a[n] == b[n]:
            n += 1
        out[i] = n
    return out


def encode(paths: list[list[bytes]]):
    """The parentheses of sorted paths, each node's path number and turn, and each path's node."""
    length = np.array([len(p) for p in paths], np.int64)
    shared = shared_turns(paths)
    tree = Parentheses(shared, length)
    owner = np.r_[0, np.repeat(np.arange(len(paths)), length - shared)]
    last = np.empty(len(paths), np.int64)     # the node where each path ends
    way = [0]
    at = 1
    for i, (s, n) in enumerate(zip(shared.tolist(), length.tolist())):
        del way[s + 1:]
        way.extend(range(at, at + n - s))
        at += n - s
        last[i] = way[n]
    return tree, owner, last


def ids_text(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def path_name(path: list[bytes]) -> list[bytes]:
    """A digest of each prefix of a path, the empty one first."""
    out, h = [], hashlib.sha256()
    out.append(h.digest())
    for turn in path:
        h.update(turn)
        out.append(h.copy().digest())
    return out


NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
SHARD = (NODE + ", shard int, side int, parent_depth int, path array<binary>, words array<long>, members array<long>, "
         "least array<long>, children array<long>, leaves array<long>, saved array<long>, node binary, ids string")
STATS = ("members", "least", "children", "leaves", "saved")


def build_shard(batches):
    """The nodes of one shard; its spines; the ids that end on spine nodes, in pieces."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    rows = sorted(zip(t.column("path").to_pylist(), t.column("conv_id").to_pylist(), t.column("words").to_pylist()),
                  key=lambda r: r[:2])
    paths, ids = [r[0] for r in rows], np.array([r[1] for r in rows], np.int64)
    shard = TaskContext.get().partitionId()
    tree, owner, last = encode(paths)
    size = len(tree.depth)
    words = np.array([0] + [rows[o][2][d - 1] for o, d in zip(owner[1:].tolist(), tree.depth[1:].tolist())], np.int64)
    ends = np.bincount(last, minlength=size)
    members = tree.sums(ends)
    first = owner                             # the members of a node are consecutive paths
    first[0] = 0
    least = least_in(ids, first, first + members)
    parent = tree.parents()
    children = np.bincount(parent[1:], minlength=size)
    # nodes of the first and of the last path; a node of both counts with the first
    side = np.full(size, -1)
    spine = [[0], [0]]
    for k, end in ((1, int(last[-1])), (0, int(last[0]))):
        node = end
        while node >= 0:
            side[node] = k
            node = parent[node]
    at = np.flatnonzero(side >= 0)
    spine = [[int(x) for x in at if side[x] == k] for k in (0, 1)]
    inner = side < 0
    leaves, saved = tree.leaves(), tree.sums(np.where(inner, (members - 1) * words, 0))
    start = np.searchsorted(last[np.argsort(last, kind="stable")], np.arange(size + 1))
    by_node = np.argsort(last, kind="stable")
    empty = hashlib.sha256(b"").hexdigest()
    sha = [empty] * size
    for n in np.flatnonzero((ends > 0) & inner).tolist():
        sha[n] = hashlib.sha256(ids_text(np.sort(ids[by_node[start[n]:start[n + 1]]]))).hexdigest()
    i = np.flatnonzero(inner)
    on_spine = side[parent[i]] >= 0 if len(i) else np.zeros(0, bool)
    yield frame({"conv_id": least[i], "depth": tree.depth[i], "n_convs": members[i], "n_children": children[i],
                 "n_leaves": leaves[i], "saved_tokens": saved[i], "ends_sha256": [sha[x] for x in i.tolist()],
                 "parent_conv_id": pa.array(least[parent[i]], mask=on_spine),
                 "shard": pa.array(np.full(len(i), shard, np.int32), mask=~on_spine),
                 "side": pa.array(side[parent[i]].astype(np.int32), mask=~on_spine),
                 "parent_depth": pa.array((tree.depth[i] - 1).astype(np.int32), mask=~on_spine)}, len(i))
    # what hangs off each spine node itself: its subtree without those of its spine children
    off = {"leaves": leaves - (children == 0), "saved": saved.copy(), "children": children.copy()}
    for n in at.tolist():
        p = parent[n]
        if p >= 0:
            off["leaves"][p] -= leaves[n]
            off["saved"][p] -= saved[n]
            off["children"][p] -= 1
    stat = {"members": members, "least": least, **off}
    out: dict[str, list] = {"shard": [], "side": [], "path": [], "words": [], **{k: [] for k in STATS}}
    for k, path in ((0, paths[0]), (1, paths[-1])):
        row = rows[0] if k == 0 else rows[-1]
        out["shard"].append(shard), out["side"].append(k), out["path"].append(path), out["words"].append(row[2])
        for s in STATS:
            # the nodes that the last path has in common with the first count there; here they add nothing
            mine = [int(stat[s][n]) for n in spine[k]]
            out[s].append([NONE if s == "least" else 0] * (len(path) + 1 - len(mine)) + mine)
    yield frame({k: pa.array(v, SCHEMA.field(k).type) for k, v in out.items()}, 2)
    for k, path in ((0, paths[0]), (1, paths[-1])):
        names = path_name(path)
        for n in spine[k]:
            held_ids = np.sort(ids[by_node[start[n]:start[n + 1]]])
            for lo in range(0, len(held_ids), PIECE):
                part = held_ids[lo:lo + PIECE]
                yield frame({"node": pa.array([names[int(tree.depth[n])]], pa.binary()),
                             "conv_id": pa.array(part[:1]), "ids": pa.array([ids_text(part).decode()])}, 1)


SCHEMA = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                              "saved_tokens")] + [("ends_sha256", pa.string())]
                   + [(c, pa.int32()) for c in ("shard", "side", "parent_depth")]
                   + [("path", pa.list_(pa.binary())), ("words", pa.list_(pa.int64()))]
                   + [(c, pa.list_(pa.int64())) for c in STATS] + [("node", pa.binary()), ("ids", pa.string())])


def frame(columns: dict, n: int) -> pa.RecordBatch:
    """A batch of :data:`SHARD`; columns not given are null."""
    return pa.RecordBatch.from_arrays([
        columns[f.name] if isinstance(columns.get(f.name), pa.Array) else
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in SCHEMA], schema=SCHEMA)


MERGED = ("node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, shard int, side int")


def merge_spines(pdf: pd.DataFrame) -> pd.DataFrame:
    """The merged spine nodes (``shard`` null), and per shard, side and depth the node there (``node`` null)."""
    pdf = pdf.sort_values(["shard", "side"], kind="stable")
    rows = [{k: getattr(r, k) for k in ("shard", "side", "path", "words", *STATS)} for r in pdf.itertuples()]
    paths = [list(r["path"]) for r in rows]
    tree, owner, _ = encode(paths)
    size = len(tree.depth)
    sums = {k: np.zeros(size, np.int64) for k in ("members", "children", "leaves", "saved")}
    least = np.full(size, NONE)
    way, at, places = [0], 1, []
    for r, path, s in zip(rows, paths, shared_turns(paths).tolist()):
        del way[s + 1:]
        way.extend(range(at, at + len(path) - s))
        at += len(path) - s
        here = np.array(way[:len(path) + 1])
        places.append(here)
        for k in sums:
            sums[k][here] += np.asarray(r[k], np.int64)
        least[here] = np.minimum(least[here], np.asarray(r["least"], np.int64))
    words = np.array([0] + [int(rows[o]["words"][d - 1]) for o, d in zip(owner[1:].tolist(), tree.depth[1:].tolist())],
                     np.int64)
    parent = tree.parents()
    children = sums["children"] + np.bincount(parent[1:], minlength=size)
    leaves = tree.sums(sums["leaves"] + (children == 0))
    saved = tree.sums(sums["saved"] + (sums["members"] - 1) * words)
    names: dict[int, bytes] = {}
    for path, here in zip(paths, places):
        names.update(zip(here.tolist(), path_name(path)))
    up = [None] + [int(least[p]) for p in parent[1:].tolist()]
    nodes = pd.DataFrame({"node": [names[i] for i in range(size)], "conv_id": least, "depth": tree.depth,
                          "parent_conv_id": pd.array(up, "Int64"), "n_convs": sums["members"], "n_children": children,
                          "n_leaves": leaves, "saved_tokens": saved, "shard": pd.array([None] * size, "Int32"),
                          "side": pd.array([None] * size, "Int32")})
    flat = np.concatenate(places)
    many = [len(p) for p in places]
    back = pd.DataFrame({"node": None, "conv_id": least[flat], "depth": tree.depth[flat],
                         "parent_conv_id": pd.array([None] * len(flat), "Int64"), "n_convs": 0, "n_children": 0,
                         "n_leaves": 0, "saved_tokens": 0,
                         "shard": pd.array(np.repeat([r["shard"] for r in rows], many), "Int32"),
                         "side": pd.array(np.repeat([r["side"] for r in rows], many), "Int32")})
    return pd.concat([nodes, back])


def hash_pieces(batches):
    """SHA-256 of each node's ids, whose pieces come one after the other."""
    node, h = None, None
    for b in batches:
        for n, ids in zip(b.column(0).to_pylist(), b.column(1)):
            if n != node:
                if h:
                    yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([h.hexdigest()])], names=["name", "sha"])
                node, h = n, hashlib.sha256(ids.as_py().encode())
            else:
                h.update(b"," + ids.as_py().encode())
    if h:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([h.hexdigest()])], names=["name", "sha"])


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; the role's length keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def paths_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, path, words)``: each conversation's turns in order, as digests with their numbers of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), turn_digest(role, text).alias("digest"), words.alias("words")).alias("t"))
    made = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))    # null turns first
    return made.select("conv_id", F.col("t.digest").alias("path"), F.col("t.words").alias("words"))


def rebuilt(paths: DataFrame, spine: int = SPINE, head: int = HEAD) -> DataFrame:
    """Conversations whose first turns are those of the conversation at the multiple of ``spine`` below."""
    h = (F.crc32(F.col("conv_id").cast("string")) % head).cast("int")
    base = paths.where(F.col("conv_id") % spine == 0).select(
        F.col("conv_id").alias("b"), F.slice("path", 1, head - 1).alias("bp"), F.slice("words", 1, head - 1).alias("bw"))
    own = paths.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % spine)
    cut = lambda c, b: F.concat(F.slice(F.coalesce(F.col(b), F.array()), F.lit(1), F.col("h")),
                                F.slice(F.col(c), F.col("h") + 1, F.size(c)))
    return own.join(base, own.base == base.b, "left").select(
        "conv_id", cut("path", "bp").alias("path"), cut("words", "bw").alias("words"))


def prefix_trie(paths: DataFrame) -> DataFrame:
    """Rows of :data:`NODE`, one per distinct sequence of first turns of ``paths`` (conv_id, path, words).

    The root is the empty sequence; an empty table gives no rows.  Runs jobs:
    the shards' tries are written.
    """
    dealt = paths.repartitionByRange("path", "conv_id")
    parts = keep_only(dealt.mapInArrow(build_shard, SHARD), "trie-shards")
    spines = parts.where("path is not null").select("shard", "side", "path", "words", *STATS)
    merged = keep_only(spines.withColumn("level", F.lit(2)).groupBy("level").applyInPandas(merge_spines, MERGED), "trie-spines")
    ends = parts.where("node is not null").select("node", "ids", "conv_id").repartition("node").sortWithinPartitions(
        "node", "conv_id").select("node", "ids").mapInArrow(hash_pieces, "name binary, sha string")
    nodes = merged.where("node is not null")
    nodes = nodes.join(ends, nodes.node == ends.name, "left")
    columns = [c.split()[0] for c in NODE.split(", ")]
    top = nodes.withColumn("ends_sha256", F.coalesce("sha", F.sha2(F.lit(""), 256))).select(columns)
    inner = parts.where("depth is not null")
    back = merged.where("node is null").select(F.col("shard").alias("s"), F.col("side").alias("k"),
                                               F.col("depth").cast("int").alias("d"), F.col("conv_id").alias("up"))
    hung = inner.where("shard is not null").join(back, (F.col("shard") == F.col("s")) & (F.col("side") == F.col("k")) & (
        F.col("parent_depth") == F.col("d"))).withColumn("parent_conv_id", F.col("up"))
    return top.union(inner.where("shard is null").select(columns)).union(hung.select(columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations; see :func:`prefix_trie`.

    Turns go by ``turn`` (null first; equal ones by a digest of role and text,
    repeated rows are repeated turns).  Null role or text is empty; rows without
    a conv_id belong to no conversation.  A conversation is one row of digests,
    as long as its turns.
    """
    return prefix_trie(rebuilt(paths_of(conversations)))
