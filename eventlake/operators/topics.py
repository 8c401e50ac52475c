"""Topic logs: single-partition reads, offset ranges and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.keys import key_partition
from eventlake.operators.numbering import dense_numbers

# Fixed value: topics with this prefix belong to the broker itself.
INTERNAL_PREFIX = "__"


def read_partition(log: DataFrame, topic: str, partition: int, from_offset: int = 0) -> DataFrame:
    """Records of one partition from an offset on; order by ``offset`` to replay them."""
    return log.where(
        (F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("offset") >= from_offset)
    )


def visible_topics(log: DataFrame, *error_columns: str) -> DataFrame:
    """Leave out internal topics, and topics or partitions that report an error code."""
    keep = F.col("topic").isNotNull() & (F.col("topic") != "") & ~F.col("topic").startswith(INTERNAL_PREFIX)
    for name in error_columns:
        keep = keep & (F.coalesce(F.col(name), F.lit(0)) == 0)
    return log.where(keep)


def log_size(beginning: Column, latest: Column) -> Column:
    """Records between two offsets, never negative; null when either end is unknown."""
    return F.when(beginning.isNotNull() & latest.isNotNull(), F.greatest(F.lit(0), latest - beginning))


def topic_offsets(log: DataFrame) -> DataFrame:
    """Beginning, latest and size per (topic, partition). ``latest`` is the next offset to be written."""
    ranges = log.groupBy("topic", "partition").agg(
        F.min("offset").alias("beginning_offset"), (F.max("offset") + 1).alias("latest_offset")
    )
    return ranges.withColumn("log_size", log_size(F.col("beginning_offset"), F.col("latest_offset")))


def topic_totals(offsets: DataFrame, selected: str | None = None) -> DataFrame:
    """Topics, partitions and total size; the size is that of one topic when one is selected."""
    size = F.coalesce("log_size", F.lit(0))
    if selected:
        size = F.when(F.col("topic") == selected, size).otherwise(0)
    return offsets.agg(
        F.countDistinct("topic").alias("topics"),
        F.count(F.lit(1)).alias("partitions"),
        F.sum(size).alias("log_size"),
    )


def sorted_offsets(offsets: DataFrame) -> DataFrame:
    return offsets.orderBy("topic", "partition")


def routed_records(records: DataFrame, topic: str, partitions: int, key: str = "key", order: str = "seq") -> DataFrame:
    """Records with the ``topic`` and the ``partition`` of their key.

    A record without key may go anywhere; it is dealt by a hash of its order number.
    """
    anywhere = F.pmod(F.xxhash64(order), F.lit(partitions)).cast("int")
    return records.withColumn("topic", F.lit(topic)).withColumn("partition", F.coalesce(key_partition(F.col(key), partitions), anywhere))


def record_offsets(routed: DataFrame, order: str = "seq", ends: DataFrame | None = None, blocks: int | None = None) -> DataFrame:
    """Routed records with their ``offset``: dense per (topic, partition), in the order of ``order``.

    Records of one key are in one partition, so they keep their order. ``ends`` (topic, partition, offset) has the
    next offset of each partition that holds records already.
    """
    return dense_numbers(routed, ["topic", "partition"], [order], "offset", ends, blocks)


def next_offsets(log: DataFrame) -> DataFrame:
    """The offset that follows the last one of each (topic, partition)."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))
