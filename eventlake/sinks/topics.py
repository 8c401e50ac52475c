"""Publishing keyed records."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators.topics import next_offsets, record_offsets, routed_records

# A publisher takes (key, value) records. Records of one call have no order among themselves.
Publisher = Callable[[DataFrame], None]

_log = logging.getLogger(__name__)


def kafka_publisher(servers: str, topic: str) -> Publisher:
    """Batch writes to a topic; needs the Kafka connector."""

    def publish(records: DataFrame) -> None:
        (
            records.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .save()
        )

    return publish


def parquet_publisher(folder: str) -> Publisher:
    """Appends the records to a Parquet log; stands in for a topic where there is no broker."""

    def publish(records: DataFrame) -> None:
        stamped = records.select("key", "value").withColumn("published_at", F.current_timestamp())
        stamped.write.mode("append").parquet(folder)

    return publish


# A record of a kept log; topic and partition are folders.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
    ]
)


def read_log(spark, folder: str) -> DataFrame:
    """Records of a log kept by ``publish_in_order``; empty when nothing has been published."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LOG_SCHEMA)
        raise


def publish_in_order(records: DataFrame, folder: str, topic: str, partitions: int, order: str = "seq") -> DataFrame:
    """Append (key, value) records to a Parquet log and return each one's place: ``key, topic, partition, offset``.

    Records of one key go to one partition and keep the order of ``order``; offsets go on from what the log holds.
    One publisher at a time may write a log. Reading the log's ends reads one column.
    """
    log = read_log(records.sparkSession, folder)
    routed = routed_records(records.select("key", "value", order), topic, partitions, order=order)
    placed = record_offsets(routed, order, next_offsets(log.where(F.col("topic") == topic)))
    placed.select(*LOG_SCHEMA.fieldNames()).write.mode("append").partitionBy("topic", "partition").parquet(folder)
    return placed.select("key", "topic", "partition", "offset", order)


def best_effort(publish: Publisher) -> Publisher:
    """The same publisher, but a failure is logged and does not reach the caller."""

    def attempt(records: DataFrame) -> None:
        try:
            publish(records)
        except Exception as error:  # any connector or job failure: the batch must go on
            _log.warning("status records were not published: %s", error)

    return attempt
