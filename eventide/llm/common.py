"""Small helpers shared by the operators: tables, written intermediates, splits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import scratch_path

#: Spark then removes a query's shuffle files as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs a read of the written table, not a
    recomputation of everything before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._eventide_path = path
    return out


def keep_only(df: DataFrame, label: str) -> DataFrame:
    """:func:`keep`, whose write leaves no shuffle files behind (:data:`CLEANUP`): nothing else may use its shuffles."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return keep(df, label)
    finally:
        conf.set(CLEANUP, before)


def release(*frames: DataFrame) -> None:
    """Delete tables made by :func:`keep` that no later step reads."""
    for df in frames:
        path = getattr(df, "_eventide_path", None)
        if path:
            sc = df.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def rekeyed(c: Column | str) -> Column:
    """The same long key as a fresh expression.

    A join side that was already partitioned by its key gets its own exchange,
    so AQE may split a hot key's partition on the other side.
    """
    return F.shiftleft(c, 0)    # the optimiser folds c * 1 away


def arrow_map(fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """Lift a per-batch function to the iterator form of ``mapInArrow``."""
    def run(batches):
        for b in batches:
            yield from fn(b)
    return run


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, null as empty."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [t or b"" for t in col.to_pylist()]


def slices(batch: pa.RecordBatch, limit: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts stay near ``limit`` bytes (one row at least)."""
    col = batch.column(batch.schema.get_field_index(name))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    lo = total = 0
    for i, s in enumerate(sizes):
        if i > lo and total + s > limit:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += s
    if lo < len(sizes):
        yield batch.slice(lo)
