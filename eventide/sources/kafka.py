"""Kafka source and sink (O-02, O-03).

The reference consumes string values from a topic and, in a helper, pushes
the lines of a file into a topic one by one from a single process.  Here both
are Spark's Kafka connector: the read is partitioned by topic partition, the
publish is a distributed write of a DataFrame.  The connector jar
(``spark-sql-kafka-0-10``) must be on the classpath; it is not bundled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest", extra: dict | None = None) -> dict:
    """Reader options for a topic (the reference's consumer properties)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, servers: str, topic: str, streaming: bool = True,
               group_id: str | None = None, starting_offsets: str = "latest") -> DataFrame:
    """String values of a topic as column ``value`` (plus ``kafka_ts``), ready for a parser."""
    opts = kafka_options(servers, topic, group_id,
                         starting_offsets if streaming else "earliest")
    reader = spark.readStream if streaming else spark.read
    df = reader.format("kafka").options(**opts).load()
    return df.select(F.col("value").cast("string").alias("value"),
                     F.col("timestamp").alias("kafka_ts"))


def publish_kafka(df: DataFrame, servers: str, topic: str, value: str = "value",
                  key: str | None = None) -> None:
    """Write one record per row (string ``value``, optional ``key``) to a topic."""
    cols = [F.col(value).cast("string").alias("value")]
    if key:
        cols.append(F.col(key).cast("string").alias("key"))
    df.select(*cols).write.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).save()
