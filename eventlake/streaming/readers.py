"""Streams over folders of files, and starting queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Fixed value: how often a running pipeline looks for new records.
TRIGGER_INTERVAL = "5 seconds"

BatchHandler = Callable[[DataFrame, int], None]


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over Parquet files, oldest first; the same columns a topic reader would give."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def start(
    stream: DataFrame,
    handler: BatchHandler,
    checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
    name: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``handler`` on every micro-batch. ``interval=None`` handles what is there and stops.

    The checkpoint holds the reader's position: give each purpose its own.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(handler).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_available(stream: DataFrame, handler: BatchHandler, checkpoint: str, mode: str = "append") -> None:
    """Handle everything that is there now and return; errors of the query are raised here."""
    start(stream, handler, checkpoint, interval=None, mode=mode).awaitTermination()
