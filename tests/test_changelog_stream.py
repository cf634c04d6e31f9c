"""The incremental changelog: add and retract rows per micro-batch, and state that ends."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators import topn, windows
from eventide.streaming import sinks
from eventide.streaming.changelog import stream_changelog

T0 = dt.datetime(2024, 1, 1)
M = dt.timedelta(minutes=1)
DDL = "item_id long, ts timestamp_ntz"
COLS = ["item_id", "window_end", "cnt", "rank"]


def _files(spark, path, parts):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(f"{path}/in/part={i}")


def _drain(spark, path, name, slide, delay=None):
    src = spark.readStream.schema(DDL).option("maxFilesPerTrigger", "1").option("latestFirst", "false").parquet(f"{path}/in/*")
    out = stream_changelog(src, "item_id", "item_id long", 2, 10 * M, slide, delay)
    ckpt = f"{path}/ckpt-{name}"
    sinks.run_stream(out, sinks.latest_batches(f"{path}/{name}"), "append", name=name, checkpoint=ckpt)
    return spark.read.parquet(f"{path}/{name}"), ckpt


@pytest.mark.parametrize("slide", [5, 4])
def test_net_rows_are_the_ranking_and_changes_follow_the_batch(spark, tmp_path, slide):
    rnd = random.Random(slide)
    parts = [[(rnd.choice([None, 1, 2, 3, 4]), T0 + rnd.randrange(0, 40) * M) for _ in range(30)] for _ in range(4)]
    parts.append([(9, T0 + 1000 * M)])          # touches windows of its own only
    path = str(tmp_path)
    _files(spark, path, parts)
    out, _ = _drain(spark, path, f"t_log{slide}", slide * M)
    rows = spark.createDataFrame([r for p in parts for r in p if r[0] is not None], DDL)
    want = topn.topn_per_window(windows.sliding_count(rows, ["item_id"], 10 * M, slide * M), 2, "item_id").select(*COLS)
    got = sinks.net_rows(out.drop("batch")).select(*COLS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert out.where("op = '-'").count() > 0
    last = out.where(F.col("window_end") > F.lit(T0 + 500 * M))
    only = last.select("batch").distinct().collect()
    assert len(only) == 1 and out.where(F.col("batch") == only[0].batch).exceptAll(last).count() == 0
    # every retracted row was there before: no row is ever below zero
    by = out.groupBy(*COLS).agg(F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("n"))
    assert by.where("n < 0 or n > 1").count() == 0


def test_state_of_closed_windows_ends(spark, tmp_path):
    path = str(tmp_path)
    _files(spark, path, [[(1, T0), (2, T0 + M)], [(3, T0 + 100 * M)], [(4, T0 + 300 * M)]])
    out, ckpt = _drain(spark, path, "t_logend", 5 * M, M)
    assert out.where("op = '+'").count() == 8 and out.where("op = '-'").count() == 0
    left = sinks.read_state(spark, ckpt, "counts").select("key.end_us").distinct().collect()
    ends = {int((T0 - dt.datetime(1970, 1, 1)).total_seconds() + 60 * m) * 1_000_000 for m in (305, 310)}
    assert {r.end_us for r in left} == ends


def test_empty_input(spark, tmp_path):
    path = str(tmp_path)
    _files(spark, path, [[]])
    src = spark.readStream.schema(DDL).parquet(f"{path}/in/*")
    sinks.run_stream(stream_changelog(src, "item_id", "item_id long", 2, 10 * M, 5 * M), "memory", "append", name="t_logempty")
    assert spark.table("t_logempty").count() == 0
