"""Topic readers. They need the Kafka connector on the session's class path.

All give the connector's columns: key, value, topic, partition, offset, timestamp, timestampType.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """A stream over a topic. Readers are independent: each keeps its place in its own checkpoint.

    ``min_partitions`` lets Spark split busy topic partitions into several tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def partition_batch(spark: SparkSession, servers: str, topic: str, partition: int) -> DataFrame:
    """One partition of a topic from its beginning, as a static frame."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("assign", json.dumps({topic: [partition]}))
        .option("startingOffsets", "earliest")
        .load()
    )


def topic_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All retained records of a topic, for offset ranges and recomputing state from the log."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def decoded(records: DataFrame) -> DataFrame:
    """Key and value as text; a missing key stays null."""
    return records.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})
