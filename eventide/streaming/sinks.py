"""Stream sinks and runners (O-04..O-07, O-54).

Everything written here is idempotent per micro-batch, because
``foreachBatch`` is at-least-once: a retried batch rewrites the same rows.
Checkpoints live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import scratch_path


def run_stream(df: DataFrame, sink: str | Callable = "memory", mode: str = "append",
               name: str | None = None, checkpoint: str | None = None,
               available_now: bool = True, options: dict | None = None):
    """O-54: start a stream and (with ``available_now``) drain what is there.

    ``sink`` is a format name (``memory``, ``parquet``, ``console``, ``kafka``)
    or a ``foreachBatch`` function ``(batch_df, batch_id)``.
    """
    spark = df.sparkSession
    ckpt = checkpoint or scratch_path(spark, f"stream-{name or 'job'}")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink)
    if name:
        w = w.queryName(name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def console_sink(df: DataFrame, label: str, mode: str = "append", **kw):
    """O-04: print a stream with a label column, every row of every batch and whole values."""
    kw["options"] = {"numRows": str(2 ** 31 - 1), "truncate": "false"} | (kw.get("options") or {})
    return run_stream(df.withColumn("tag", F.lit(label)), "console", mode, **kw)


def split_by_tag(df: DataFrame, tag: str = "tag") -> Callable[[str], DataFrame]:
    """O-07: side outputs.  An operator emits tagged rows; each output is a filter."""
    return lambda value: df.filter(F.col(tag) == value)


def upsert_batch(path: str, keys: list[str], version: str | None = None) -> Callable:
    """O-05: ``foreachBatch`` writer that keeps the latest row per key in a parquet table.

    The batch is merged with the current table (latest ``version`` per key
    wins, the batch winning ties) and written as a new table generation, so a
    retried batch yields the same table.  The reference's ``hset`` per element
    becomes one distributed merge per micro-batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        cur_path = f"{path}/gen={batch_id:012d}"
        earlier = sorted(i for i in (int(g.rsplit("=", 1)[1]) for g in _list_generations(spark, path))
                         if i < batch_id)
        prev_gen = [f"{path}/gen={i:012d}" for i in earlier]
        merged = batch.withColumn("_pri", F.lit(1))
        if prev_gen:
            old = spark.read.parquet(prev_gen[-1]).withColumn("_pri", F.lit(0))
            merged = old.unionByName(merged, allowMissingColumns=True)
        order = ([F.col(version)] if version else []) + [F.col("_pri")]
        latest = merged.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in merged.columns]),
                                                    F.struct(*order)).alias("_r")).select("_r.*")
        latest.drop("_pri").write.mode("overwrite").parquet(cur_path)

    return write


def _list_generations(spark: SparkSession, path: str, prefix: str = "gen=") -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [s.getPath().toString() for s in fs.listStatus(hpath) if s.getPath().getName().startswith(prefix)]


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The newest generation of an ``upsert_batch`` table."""
    last = max(int(g.rsplit("=", 1)[1]) for g in _list_generations(spark, path))
    return spark.read.parquet(f"{path}/gen={last:012d}")


def changelog_batch(state_path: str, compute: Callable[[DataFrame], DataFrame],
                    out_path: str) -> Callable:
    """O-06 in a stream: after each batch, recompute the result and write its changelog.

    The batch input is kept under ``state_path/input/batch=<id>``; ``compute``
    turns all input up to this batch into the current result; the add/retract
    rows against the previous batch's result go to ``out_path/batch=<id>``.
    Every write overwrites its batch folder, so a retried batch is idempotent.
    """
    from eventide.operators.topn import changelog

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{state_path}/input/batch={batch_id}")
        acc = spark.read.parquet(f"{state_path}/input").filter(F.col("batch") <= batch_id).drop("batch")
        curr = compute(acc)
        prev = (spark.read.parquet(f"{state_path}/result/batch={batch_id - 1}") if batch_id > 0
                else curr.limit(0))
        changelog(prev, curr).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        curr.write.mode("overwrite").parquet(f"{state_path}/result/batch={batch_id}")

    return write


def latest_batches(path: str) -> Callable:
    """``foreachBatch`` writer of an ``update`` stream: each micro-batch's rows in a folder of its own, by its number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def net_rows(changes: DataFrame, op: str = "op") -> DataFrame:
    """What a changelog of whole rows (``+`` and ``-``) leaves, repeated rows repeated."""
    rest = [c for c in changes.columns if c != op]
    n = changes.groupBy(*rest).agg(F.sum(F.when(F.col(op) == "+", 1).otherwise(-1)).alias("_n"))
    return n.where("_n > 0").select(*rest, F.explode(F.sequence(F.lit(1), "_n")).alias("_i")).drop("_i")


def read_state(spark: SparkSession, checkpoint: str, variable: str | None = None, operator: int = 0) -> DataFrame:
    """O-05: the table that a running or ended stream keeps per key, read from its state store.

    The state of a keyed aggregate *is* the table of the latest value per key;
    columns are the grouping columns and the aggregate's buffer.  ``variable``
    names a state variable of a ``transformWithState`` job.
    """
    r = spark.read.format("statestore").option("operatorId", str(operator))
    if variable:
        r = r.option("stateVarName", variable)
    return r.load(checkpoint)
