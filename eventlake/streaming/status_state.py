"""Pipeline state kept up to date from a stream of status messages.

``keep_state`` and ``fields_of_state`` use Spark's state store as the only copy; ``update_handler`` and ``read_state``
keep the changes of each batch for readers that follow them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.status import field_rows, invalid_status, merge_fields, parse_status, valid_status
from eventlake.streaming.detector import rocksdb
from eventlake.streaming.readers import BatchHandler

RETAINED_VERSIONS = "spark.sql.streaming.minBatchesToRetain"
# The stores of an executor share one bound of memory, and no row is looked up only to be counted.
STORE = "spark.sql.streaming.stateStore.rocksdb"
STORE_SETTINGS = {f"{STORE}.boundedMemoryUsage": "true", f"{STORE}.trackTotalNumberOfRows": "false"}
FIELD_SCHEMA = "event_id string, stage string, field string, field_value string, arrival long"


def field_stream(messages: DataFrame) -> DataFrame:
    """Latest value per (event, stage, field) of a stream of (arrival, value) status messages.

    A streaming aggregation: run it in update mode, and a batch gives the fields it has changed. The
    state is in Spark's state store, so a batch costs what it touches.
    """
    rows = field_rows(valid_status(parse_status(messages)))
    latest = rows.groupBy("event_id", "stage", "field").agg(F.max(F.struct("arrival", "field_value")).alias("latest"))
    return latest.select("event_id", "stage", "field", F.col("latest.field_value").alias("field_value"), F.col("latest.arrival").alias("arrival"))


def keep_state(stream: DataFrame, checkpoint: str, versions: int = 2) -> None:
    """Bring the state up to what there is now. Nothing is written but the state in the checkpoint folder.

    Only ``versions`` earlier versions of the state are kept, so the folder grows with the fields, not with the batches.
    The state is in RocksDB: on disk and in bounded memory, where Spark's default holds all of it, in several versions,
    in the heap. A checkpoint that another store began cannot be gone on with.
    """
    conf = stream.sparkSession.conf
    settings = {RETAINED_VERSIONS: str(versions), **STORE_SETTINGS}
    before = {name: conf.get(name, None) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)
    try:
        with rocksdb(stream.sparkSession):
            writer = stream.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
            writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


def fields_of_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The folded fields as the state store holds them: one row per (event, stage, field), read by partition."""
    state = spark.read.format("statestore").load(checkpoint)
    latest = F.col("value").getField(state.schema["value"].dataType.fieldNames()[0])
    key = F.col("key")
    return state.select(
        *[key.getField(name).alias(name) for name in ("event_id", "stage", "field")],
        latest.getField("field_value").alias("field_value"),
        latest.getField("arrival").alias("arrival"),
    )


def rejected_stream(messages: DataFrame) -> DataFrame:
    """The (key, value) records of unusable messages of the stream, to be published by a query of its own."""
    return invalid_status(parse_status(messages)).select(F.col("event_id").alias("key"), "value")


def update_handler(folder: str) -> BatchHandler:
    """Keeps the changes of each batch in its own partition; a batch that runs again replaces them."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch_id={batch_id}")

    return handle


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    """The folded fields after all batches: of the changes to a field the latest."""
    return merge_fields(spark.read.schema(FIELD_SCHEMA).parquet(folder))
