"""Each event once, however often the log delivers it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.times import parse_iso

# How much later than the newest event time a row may still come.
DELAY = "1 day"


def once_only(stream: DataFrame, key: str = "event_id", time: str = "timestamp", delay: str = DELAY) -> DataFrame:
    """Rows of a stream whose ``key`` has not been seen before; ``time`` is ISO text or a timestamp.

    Seen keys are kept in Spark's state store until the watermark, the newest time less ``delay``, has passed them,
    so neither the table nor earlier batches are read, and the state does not grow with the stream. Rows that come
    behind the watermark are dropped as well: a replay of old events is late or known, in both cases it adds nothing.
    Rows without key or readable time are dropped, since nothing can tell whether they were seen.
    """
    text = dict(stream.dtypes)[time] == "string"
    at = parse_iso(F.col(time)) if text else F.col(time).cast("timestamp")
    timed = stream.withColumn("_time", at).where(F.col(key).isNotNull() & F.col("_time").isNotNull())
    return timed.withWatermark("_time", delay).dropDuplicatesWithinWatermark([key]).drop("_time")
