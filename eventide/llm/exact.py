"""Exact dedup over an extendible-hash index kept on shared files.

Every text (A-Z lower-cased) has a 64-bit key.  A directory of key prefixes
doubles its depth as long as a bucket holds more than ``capacity`` keys; it is
as deep as the number of keys asks for.  Each row is routed through it to its
bucket, where the texts of one key form a chain: rows share a link of it only if
their bytes are equal (the key column and the whole text are grouped on).  The
index, one entry per link with the number of rows and the largest doc_id, is
written in key ranges, bucket by bucket, and every row looks up its link there.
Directory, index and result get as many parts as their rows ask for, however
many a shuffle has: each file costs the executor that writes it some processes.

Only DataFrame functions run here.  A text crosses one shuffle, and once per
task however many rows share it there; all else moves keys and digests.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import keep

CAPACITY = 1 << 12    # keys of a bucket before it splits
SPARE = 3             # doublings beyond those that evenly spread keys ask for
KEY_BITS = 64
FILE_ROWS = 1 << 14   # rows of a part of the directory, the index or the result


def normalised(text: Column) -> Column:
    """A-Z lower-cased only; null is empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(
        F.translate(t, ascii_uppercase, ascii_lowercase))


def slot(key: Column | str, depth: int) -> Column:
    """The first ``depth`` bits of a key."""
    return F.shiftrightunsigned(key, KEY_BITS - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, capacity: int, depth: int) -> DataFrame:
    """``(slot, bucket)``: each slot's bucket at the least depth at which it is not overfull.

    ``entries(key)`` are distinct.  A bucket is numbered ``1 << d | prefix of d
    bits``.  The directory has a row per slot in use, at most ``2**depth``; a
    bucket overfull at ``depth`` (keys that share all those bits) keeps its
    keys, whose chains stay whole.
    """
    hist = entries.groupBy(slot("key", depth).alias("slot")).agg(F.count("*").alias("n"))
    cover = hist.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumn(
        "bucket", F.expr(f"shiftleft(1L, d) + shiftright(slot, {depth} - d)"))
    full = cover.groupBy("bucket").agg(F.sum("n").alias("held")).where(
        (F.col("held") <= capacity) | (F.col("bucket") >= 1 << depth)).select(F.col("bucket").alias("b"))
    return cover.join(full, F.col("bucket") == F.col("b")).groupBy("slot").agg(F.min("bucket").alias("bucket"))


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest doc_id stays; rows that repeat that
    doc_id with that text all stay.  A null doc_id never wins over another and
    stays only where no row of its group has one (keep_id null).  An empty table
    gives no rows.  ``key_bits`` shortens the key (tests force collisions).
    """
    norm = normalised(F.col("text"))
    key = F.xxhash64("norm") if key_bits == KEY_BITS else F.shiftleft(F.xxhash64("norm"), KEY_BITS - key_bits)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm")).withColumn("key", key)
    rows = keep(src.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256")), "exact-rows")
    entries = rows.select("key").distinct()
    held, total = rows.groupBy("key").count().agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    depth = min((held // capacity).bit_length() + SPARE, KEY_BITS - 2) if held > capacity else 0
    slots = keep(directory(entries, capacity, depth).repartition((1 << depth) // FILE_ROWS + 1), "exact-directory")

    def routed(df: DataFrame) -> DataFrame:
        return df.withColumn("slot", slot("key", depth)).join(slots, "slot").drop("slot")

    chains = routed(src).groupBy("bucket", "key", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    index = keep(chains.select("bucket", "key", F.sha2("norm", 256).alias("link"), "keep_id", "group_size")
                 .repartitionByRange("bucket", "key").coalesce(held // FILE_ROWS + 1)
                 .sortWithinPartitions("bucket", "key"), "exact-index")
    links = index.select(F.col("bucket").alias("b"), F.col("key").alias("k"), "link", "keep_id", "group_size")
    found = routed(rows)
    out = found.join(links, (found.bucket == links.b) & (found.key == links.k) & (found.text_sha256 == links.link))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256").coalesce(total // FILE_ROWS + 1)


def drop_exact_duplicates(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay; rows without a doc_id stay.

    Rows that repeat a doc_id are judged each by its own text.
    """
    gone = exact_groups(docs, capacity).where("not kept and doc_id is not null").select(
        F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_text")).distinct()
    same = (docs["doc_id"] == gone["gone_id"]) & (F.sha2(normalised(docs["text"]), 256) == gone["gone_text"])
    return docs.join(gone, same, "left_anti")
