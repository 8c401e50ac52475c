"""A Parquet folder that takes the micro-batches of a stream, one partition for each batch.

A batch that runs again overwrites its own partition, so it counts once without any further
bookkeeping. Snapshots, time travel and clears need a table format; see ``sources.iceberg``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.schemas import EVENT_COLUMNS, EVENT_SCHEMA
from eventlake.sinks.lookups import lookup_writer

ROW_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("batch_id", T.LongType())])
# Holds no rows; it makes the folder readable before the first batch.
NO_BATCH = -1


@dataclass(frozen=True)
class Written:
    """What one write of a batch brought: rows, rows without event id, the range of the ids, and files with rows."""

    batch_id: int
    rows: int
    without_id: int
    first_id: str | None
    last_id: str | None
    files: int


class BatchTable:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def create(self) -> "BatchTable":
        """Make the empty table; does nothing when it is there."""
        self.spark.createDataFrame([], EVENT_SCHEMA).write.mode("ignore").parquet(self.batch_folder(NO_BATCH))
        return self

    def batch_folder(self, batch_id: int | str) -> str:
        return f"{self.folder}/batch_id={int(batch_id)}"

    def rows(self) -> DataFrame:
        """All rows with the batch that brought them; a filter on ``batch_id`` prunes folders."""
        return self.spark.read.schema(ROW_SCHEMA).parquet(self.folder)

    def current(self) -> DataFrame:
        return self.rows().select(*EVENT_COLUMNS)

    def append(self, df: DataFrame, batch_id: int, replace: bool = True) -> int:
        """``append_counted`` for callers that want the id only."""
        return self.append_counted(df, batch_id, replace).batch_id

    def append_counted(self, df: DataFrame, batch_id: int, replace: bool = True) -> Written:
        """Write the canonical columns of a batch and tell what was written.

        With ``replace`` a batch that is run again replaces what it wrote before (exactly once);
        without, it is appended again (at least once). Files are sorted by event id inside and have
        Bloom filters of it, so a lookup by id reads few row groups of the many batches.

        The figures are observed by the writing job itself, in its last stage, where Spark takes each partition's
        figures once even if its task runs again. A task writes one file, so a partition's first row stands for a file;
        a task without rows may leave an empty one, which does not count.
        """
        seen = Observation()
        # The low 33 bits number the rows of a partition.
        opens = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        counted = (
            df.select(*EVENT_COLUMNS)
            .sortWithinPartitions("event_id")
            .withColumn("_opens", opens)
            .observe(
                seen,
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col("event_id").isNull()).alias("without_id"),
                F.min("event_id").alias("first_id"),
                F.max("event_id").alias("last_id"),
                F.count_if("_opens").alias("files"),
            )
            .drop("_opens")
        )
        writer = counted.write.mode("overwrite" if replace else "append").option("maxRecordsPerFile", 0)
        lookup_writer(writer, "event_id").parquet(self.batch_folder(batch_id))
        return Written(batch_id, **seen.get)
