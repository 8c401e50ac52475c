"""From raw records to canonical usage events, and from events to keyed and status records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.json_safe import computed_once
from eventlake.functions.text import is_empty
from eventlake.functions.times import now_text
from eventlake.schemas import EVENT_COLUMNS, EVENT_SCHEMA

# Fixed value: the type every usage event carries.
USAGE_EVENT_TYPE = "usage"


def parse_events(
    records: DataFrame, value: str = "value", columns: Sequence[str] = EVENT_COLUMNS, keep: Sequence[str] = ()
) -> DataFrame:
    """JSON records to canonical events; rows without an event id (or without valid JSON) drop out.

    Only the event id and ``columns`` are parsed, so name no more than is needed. ``keep`` are
    columns of the records that stay. Works on static and streaming frames alike.
    """
    schema = T.StructType([f for f in EVENT_SCHEMA if f.name in ("event_id", *columns)])
    data = F.from_json(F.col(value).cast("string"), schema)
    parsed = records.select(*keep, computed_once(data).alias("data")).where(F.col("data.event_id").isNotNull())
    return parsed.select(*[F.col("data")[c].alias(c) for c in columns], *keep)


def usage_envelope(
    requests: DataFrame,
    user_id: str = "user_id",
    username: str = "username",
    event_id: Column | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """Wrap accepted requests into events. Ids and times are generated unless the caller gives them."""
    return requests.select(
        (F.uuid() if event_id is None else event_id).alias("event_id"),
        F.lit(USAGE_EVENT_TYPE).alias("event_type"),
        F.col(user_id).alias("user_id"),
        F.col(username).alias("username"),
        "service",
        "usage_type",
        F.col("quantity").cast("int").alias("quantity"),
        (now_text() if timestamp is None else timestamp).alias("timestamp"),
    )


def request_faults() -> Column:
    """Names of the request fields that break a rule, in field order."""
    faults = F.array(
        F.when(is_empty(F.col("service")), F.lit("service")),
        F.when(is_empty(F.col("usage_type")), F.lit("usage_type")),
        F.when(F.coalesce(F.col("quantity"), F.lit(0)) <= 0, F.lit("quantity")),
    )
    return F.filter(faults, lambda f: f.isNotNull())


def accepted_requests(requests: DataFrame) -> DataFrame:
    return requests.where(F.size(request_faults()) == 0)


def rejected_requests(requests: DataFrame) -> DataFrame:
    """Rejected requests with the offending fields in ``reason``."""
    return requests.withColumn("reason", F.array_join(request_faults(), ",")).where(F.col("reason") != "")


def batch_event_ids(batch: DataFrame) -> DataFrame:
    """Distinct non-null event ids of a batch; stays a distributed frame."""
    return batch.select("event_id").where(F.col("event_id").isNotNull()).distinct()


def keyed_records(events: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, JSON value) records of events, ready for a keyed topic."""
    body = F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"})
    others = [c for c in events.columns if c not in EVENT_COLUMNS]
    return events.select(*others, F.col(key).alias("key"), body.alias("value"))


def status_value(stage: str, status: str, extras: Mapping[str, Column]) -> Column:
    """JSON of one status message; extra fields stay beside the three fixed ones, nulls included."""
    fields = [F.col("event_id"), F.lit(stage).alias("stage"), F.lit(status).alias("status")]
    fields += [c.alias(name) for name, c in extras.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def status_records(
    event_ids: DataFrame, transitions: Sequence[tuple[str, str, Mapping[str, Column]]]
) -> DataFrame:
    """One keyed record per event id and stage transition, in transition order (``step``).

    Extras may use any column of ``event_ids``. The transitions are a short literal array on each row, so nothing is joined or shuffled.
    """
    entries = [
        F.struct(
            F.lit(step).alias("step"),
            F.lit(stage).alias("stage"),
            F.lit(status).alias("status"),
            status_value(stage, status, extras).alias("value"),
        )
        for step, (stage, status, extras) in enumerate(transitions, start=1)
    ]
    return event_ids.select(F.col("event_id").alias("key"), F.inline(F.array(*entries)))


def acknowledged_records(log: DataFrame) -> DataFrame:
    """Status records of events a topic has taken: where they went, and that Spark is next."""
    place = {name: F.col(name) for name in ("topic", "partition", "offset")}
    return status_records(log, [("kafka", "completed", place), ("spark", "processing", {})])


def refused_records(events: DataFrame, error: Column) -> DataFrame:
    """Status records of events that could not be sent."""
    return status_records(events, [("kafka", "failed", {"error": error})])


def success_transitions(
    batch_id: int, table: str, snapshot_id: Column, path: str, bucket: str, files: int
) -> list[tuple[str, str, dict[str, Column]]]:
    """Stage transitions of a batch that went through."""
    batch = {"batch_id": F.lit(batch_id).cast("long")}
    return [
        ("spark", "completed", batch),
        ("iceberg", "processing", batch),
        ("iceberg", "completed", {**batch, "table": F.lit(table), "snapshot_id": snapshot_id}),
        ("minio", "processing", batch),
        (
            "minio",
            "completed",
            {**batch, "bucket": F.lit(bucket), "path": F.lit(path), "parquet_files": F.lit(files)},
        ),
    ]


def new_rows(incoming: DataFrame, table: DataFrame, key: str = "event_id", order: Sequence[str] = ()) -> DataFrame:
    """Incoming rows whose key the table does not hold yet, one per key.

    Of rows with one key the least by ``order``, then by all columns, stays, so running a batch
    again gives the same rows. Incoming rows combine before the shuffle and are read once; give the
    table pruned to the rows that can matter.
    """
    columns = [*order, *(c for c in incoming.columns if c not in order)]
    least = F.min(F.struct(*columns)).alias("_row")
    fresh = incoming.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(least)
    missing = fresh.join(table.select(F.col(key).alias("_key")), "_key", "left_anti")
    return missing.select(*[F.col("_row")[c].alias(c) for c in incoming.columns])
