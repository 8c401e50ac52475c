"""Stage status messages folded into one state per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.json_safe import computed_once
from eventlake.functions.status_words import INITIAL_STATUS, STAGES
from eventlake.functions.text import clamp, contains_ignore_case, is_empty
from eventlake.operators.retention import CREATED, history
from eventlake.schemas import STATUS_KEYS, STATUS_PAYLOAD

# How many events the state keeps and shows.
RETAINED_EVENTS = 100
RECENT_DEFAULT = 20


def parse_status(messages: DataFrame, value: str = "value", with_extras: bool = True) -> DataFrame:
    """Required keys as columns, every other key in ``extras``; other message columns are kept.

    Without extras only the required keys are parsed, which costs less.
    """
    kept = [c for c in messages.columns if c != value]
    text = F.col(value).cast("string")
    if not with_extras:
        return messages.select(*kept, value, F.inline(F.array(F.from_json(text, STATUS_KEYS))))
    parsed = messages.select(*kept, value, computed_once(F.from_json(text, STATUS_PAYLOAD)).alias("_payload"))
    return parsed.select(
        *kept,
        value,
        *[F.col("_payload")[name].alias(name) for name in STATUS_KEYS.fieldNames()],
        F.map_filter("_payload", lambda k, _: ~k.isin(*STATUS_KEYS.fieldNames())).alias("extras"),
    )


def _complete():
    missing = F.lit(False)
    for name in STATUS_KEYS.fieldNames():
        missing = missing | is_empty(F.col(name))
    return ~missing


def valid_status(parsed: DataFrame, value: str = "value") -> DataFrame:
    return parsed.where(_complete()).drop(value)


def invalid_status(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Messages without all three required keys, or not JSON objects; reported, never fatal."""
    return parsed.where(~_complete()).drop("extras")


def unknown_status(status: DataFrame, events: DataFrame) -> DataFrame:
    """Status rows of events that were never created.

    One unknown id may own many rows. Event ids are unique, so adaptive execution can cut such a
    partition of the status side into pieces and give each the few ids it needs.
    """
    return status.join(events.select("event_id"), "event_id", "left_anti")


def fold_stages(status: DataFrame, fields: Sequence[str] = (), arrival: str = "arrival") -> DataFrame:
    """Latest state per (event, stage), field by field.

    ``status`` is that of the last message. Each named extra field keeps the value of the last
    message that carried it, null values included; messages without the field leave it alone.
    Everything is a combinable aggregate, so busy events shrink before the shuffle.
    """
    return status.groupBy("event_id", "stage").agg(*fold_columns(fields, arrival))


def fold_columns(fields: Sequence[str] = (), arrival: str = "arrival") -> list[Column]:
    """The aggregates of ``fold_stages``; rows without arrival have no part in them."""
    carried = [
        F.max_by(F.col("extras")[name], F.when(F.map_contains_key("extras", name), F.col(arrival))).alias(name) for name in fields
    ]
    return [F.max_by("status", arrival).alias("status"), *carried, F.max(arrival).alias("updated_arrival")]


def fold_fields(status: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The same fold for any set of extra fields: one row per (event, stage, field).

    ``status`` is one of the fields. Folding folded rows again with newer ones gives the fold of
    all of them, which is what the streaming state relies on.
    """
    return merge_fields(field_rows(status, arrival), arrival)


def field_rows(status: DataFrame, arrival: str = "arrival") -> DataFrame:
    """One row per message and field, ``status`` included."""
    fields = F.map_concat("extras", F.create_map(F.lit("status"), F.col("status")))
    return status.select("event_id", "stage", arrival, F.explode(fields).alias("field", "field_value"))


def merge_fields(long: DataFrame, arrival: str = "arrival") -> DataFrame:
    return long.groupBy("event_id", "stage", "field").agg(
        F.max_by("field_value", arrival).alias("field_value"), F.max(arrival).alias(arrival)
    )


def stage_documents(fields: DataFrame) -> DataFrame:
    """Folded fields as one map per (event, stage): a handful of entries each."""
    pairs = F.collect_list(F.struct("field", "field_value"))
    return fields.groupBy("event_id", "stage").agg(F.map_from_entries(pairs).alias("document"))


# The open payload with its types


def typed_status(messages: DataFrame, value: str = "value") -> DataFrame:
    """Status messages with their whole payload as a typed value, parsed once; other message columns are kept.

    The required keys come as text; a message without all three, or that is not a JSON object, has a null among them.
    """
    kept = [c for c in messages.columns if c != value]
    parsed = messages.select(*kept, value, computed_once(F.try_parse_json(F.col(value).cast("string"))).alias("payload"))
    keys = [F.try_variant_get("payload", f"$.{name}", "string").alias(name) for name in STATUS_KEYS.fieldNames()]
    return parsed.select(*kept, value, *keys, "payload")


def payload_fields(typed: DataFrame, arrival: str = "arrival") -> DataFrame:
    """One row per message and field of its payload but the event id and stage, the value with its type."""
    spark = typed.sparkSession
    named = typed.select("event_id", "stage", arrival, "payload")
    fields = named.lateralJoin(spark.tvf.variant_explode(F.col("payload").outer())).where(~F.col("key").isin("event_id", "stage"))
    return fields.select("event_id", "stage", arrival, F.col("key").alias("field"), F.col("value").alias("field_value"))


def fold_payload(typed: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Latest value per (event, stage, field) with its JSON type: numbers, booleans, objects and arrays stay what they are.

    ``field_value`` is the value, ``field_json`` its JSON text and ``field_type`` its type; an explicit null (type VOID)
    overwrites what was there, a message without the field leaves it alone.
    """
    valid = typed.where(_complete())
    latest = merge_fields(payload_fields(valid, arrival), arrival)
    return latest.select(
        "event_id", "stage", "field", "field_value", F.to_json("field_value").alias("field_json"), F.schema_of_variant("field_value").alias("field_type"), arrival
    )


def stages_from_fields(folded: DataFrame, fields: Sequence[str] = (), arrival: str = "arrival") -> DataFrame:
    """Rows of ``fold_fields`` as the columns of ``fold_stages``."""
    return folded.groupBy("event_id", "stage").agg(
        *[F.max(F.when(F.col("field") == f, F.col("field_value"))).alias(f) for f in ("status", *fields)],
        F.max(arrival).alias("updated_arrival"),
    )


def initial_rows(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The five stages of every created event in their initial status, which ``_first`` has."""
    first = F.map_from_arrays(F.lit(list(INITIAL_STATUS)), F.lit(list(INITIAL_STATUS.values())))
    return events.select("event_id", *keep, F.explode(first).alias("stage", "_first"))


def _of_created(merged: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Only stages of created events, with the initial status where there is no other and ``keep`` of the event.

    ``merged`` has one row per (event, stage), so the window sees an event's stages, not its messages.
    """
    own = Window.partitionBy("event_id")
    known = F.max(F.col("_first").isNotNull()).over(own)
    rest = [c for c in merged.columns if c not in ("event_id", "stage", "status", "_first", *keep)]
    return (
        merged.withColumn("_known", known)
        .withColumns({name: F.max(name).over(own) for name in keep})
        .where("_known")
        .select("event_id", *keep, "stage", F.coalesce("status", "_first").alias("status"), *rest)
    )


def with_initial_state(events: DataFrame, folded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """State of every created event from folded stages, one row per stage, with ``keep`` of its columns.

    Each event starts with the five stages in their initial status; further stages appear when a
    message names them. Messages of unknown events have no effect. ``updated_arrival`` is null for
    a stage no message has touched.
    """
    others = [c for c in folded.columns if c not in ("event_id", "stage")]
    rows = folded.unionByName(initial_rows(events, keep), allowMissingColumns=True)
    merged = rows.groupBy("event_id", "stage").agg(*[F.any_value(c, F.lit(True)).alias(c) for c in (*others, "_first", *keep)])
    return _of_created(merged, keep)


def pipeline_state(
    events: DataFrame, status: DataFrame, fields: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """State of every created event after all its status messages.

    Messages and initial rows are folded by one aggregate, so the messages are read and parsed once.
    """
    needed = ["event_id", "stage", "status", "arrival", *(["extras"] if fields else [])]
    rows = status.select(*needed).unionByName(initial_rows(events, keep), allowMissingColumns=True)
    first = [F.max(c).alias(c) for c in ("_first", *keep)]
    return _of_created(rows.groupBy("event_id", "stage").agg(*fold_columns(fields), *first), keep)


def event_state(state: DataFrame, event_id: str) -> DataFrame:
    """State of one event; an event that was never created is an error."""
    found = state.where(F.col("event_id") == event_id)
    if found.limit(1).isEmpty():
        raise LookupError(f"event not found: {event_id}")
    return found


def pipeline_summary(events: DataFrame, status: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Per event: status of the five stages, completed and failed stages, overall status."""
    latest = status.groupBy("event_id").agg(
        *[F.max_by("status", F.when(F.col("stage") == s, F.col(arrival))).alias(s) for s in STAGES]
    )
    stages = {s: F.coalesce(F.col(s), F.lit(INITIAL_STATUS[s])) for s in STAGES}
    filled = events.select("event_id").join(latest, "event_id", "left").select(
        "event_id", *[c.alias(s) for s, c in stages.items()]
    )
    counts = {
        "completed_stages": sum(((F.col(s) == "completed").cast("int") for s in STAGES), F.lit(0)),
        "failed_stages": sum(((F.col(s) == "failed").cast("int") for s in STAGES), F.lit(0)),
    }
    overall = (
        F.when(F.col("failed_stages") > 0, "failed")
        .when(F.col("completed_stages") == len(STAGES), "completed")
        .otherwise("processing")
    )
    return (
        filled.withColumns(counts)
        .withColumn("total_stages", F.lit(len(STAGES)))
        .withColumn("overall_status", overall)
    )


def pipeline_overview(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("completed_stages") == F.col("total_stages")).alias("completed"),
        F.count_if(F.col("failed_stages") > 0).alias("failed"),
    )


def retained_events(
    events: DataFrame, status: DataFrame, keep: int = RETAINED_EVENTS, created: str = "created_arrival", blocks: int | None = None
) -> DataFrame:
    """The events the state still holds, most recently touched first; ``messages`` counted since their creation.

    Exact: a message that arrives for an event after its eviction has no effect.
    """
    held = history(events, status.select("event_id", "arrival"), keep, created, blocks).held
    return held.orderBy(F.desc("touched_arrival"), F.desc("event_id"))


def recent_events(
    events: DataFrame,
    status: DataFrame,
    limit: int = RECENT_DEFAULT,
    fields: Sequence[str] = (),
    keep: int = RETAINED_EVENTS,
) -> DataFrame:
    """State of the most recently touched of the retained events, oldest first.

    The messages are parsed once, when the history is dealt. At most ``keep`` ids are chosen (the limit is clamped); they
    are looked up now and put into the scan of the dealt rows as literals. A retained event has been held since its
    creation, so all its messages from there on count.
    """
    needed = ["event_id", "stage", "status", "arrival", *(["extras"] if fields else [])]
    past = history(events, status.select(*needed), keep)
    chosen = past.held.orderBy(F.desc("touched_arrival"), F.desc("event_id")).limit(clamp(limit, 1, keep))
    ids = [row.event_id for row in chosen.select("event_id").collect()]
    chosen = F.broadcast(past.held.where(F.col("event_id").isin(ids)))
    theirs = past.rows.where(F.col("event_id").isin(ids) & ~F.col(CREATED)).select(*needed)
    since = chosen.select("event_id", "created_arrival")
    theirs = theirs.join(since, "event_id").where(F.col("arrival") > F.col("created_arrival")).drop("created_arrival")
    return pipeline_state(chosen, theirs, fields, ("touched_arrival",)).orderBy("touched_arrival", "event_id")


def search_status(state: DataFrame, query: str = "", topic: str | None = None, trim: bool = True) -> DataFrame:
    """Events of one topic whose id or topic contains the query, letter case aside."""
    needle = query.strip() if trim else query
    found = state
    if topic:
        found = found.where(F.col("topic") == topic)
    if needle:
        found = found.where(
            contains_ignore_case(F.col("event_id"), needle) | contains_ignore_case(F.col("topic"), needle)
        )
    return found
