"""Every registered query: a name, and a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.json_safe import id_text, json_safe
from eventlake.functions.keys import key_partition
from eventlake.functions.status_words import normalized_status
from eventlake.functions.text import head_preview, preview
from eventlake.operators import compare, directory, history, ingest, security, status, topics, usage
from eventlake.plans import fixtures as fx
from eventlake.schemas import EVENT_COLUMNS
from eventlake.session import work_folder
from eventlake.sinks.batches import BatchTable
from eventlake.sinks.lookups import write_sorted
from eventlake.sinks.topics import parquet_publisher, publish_in_order, read_log
from eventlake.sources import files
from eventlake.sources.tables import read_table
from eventlake.streaming import dedup, detector, pipeline, readers, status_state

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

# The test data spreads failed logins over days, so the incident queries use a three-day window.
INCIDENT_WINDOW_SECONDS = 3 * 24 * 3600
# Partitions of the topics.
TOPIC_PARTITIONS = 3
STATUS_FIELDS = ("batch_id", "snapshot_id", "topic", "partition")


def query(fn: Query) -> Query:
    """Register a query. Event times are UTC, so the session zone is set before it is planned."""

    @wraps(fn)
    def in_utc(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, folder)

    _QUERIES[fn.__name__] = in_utc
    return in_utc


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Ingest


@query
def parse_events(spark, folder):
    return ingest.parse_events(fx.usage_json(spark, folder))


@query
def usage_envelope(spark, folder):
    requests = fx.usage(spark, folder).withColumn("given_id", F.concat(F.lit("req-"), "seq"))
    return ingest.usage_envelope(
        ingest.accepted_requests(requests), event_id=F.col("given_id"), timestamp=F.col("timestamp")
    )


@query
def usage_generated(spark, folder):
    """What holds for generated ids and times: ids are distinct, both have their format."""
    made = ingest.usage_envelope(ingest.accepted_requests(fx.usage(spark, folder)))
    return made.agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("event_id").alias("ids"),
        F.every(F.col("event_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("ids_well_formed"),
        F.every(F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$")).alias("times_well_formed"),
    )


@query
def usage_accepted(spark, folder):
    return ingest.accepted_requests(fx.usage(spark, folder)).select("seq", "service", "usage_type", "quantity")


@query
def usage_rejected(spark, folder):
    return ingest.rejected_requests(fx.usage(spark, folder)).select(
        "seq", "service", "usage_type", "quantity", "reason"
    )


@query
def batch_event_ids(spark, folder):
    return ingest.batch_event_ids(fx.usage(spark, folder))


@query
def keyed_records(spark, folder):
    """Keyed JSON records, ready for a topic."""
    return ingest.keyed_records(fx.usage(spark, folder)).select("key", "value")


@query
def key_partitions(spark, folder):
    """Partition of every key of the usage topic."""
    keys = fx.usage(spark, folder).select("seq", F.concat(F.col("username"), F.lit("/"), F.col("user_id")).alias("key"))
    return keys.withColumn("partition", key_partition(F.col("key"), TOPIC_PARTITIONS))


@query
def record_offsets(spark, folder):
    """Place of every usage record: the partition of its key, and a dense offset in order of arrival."""
    records = ingest.keyed_records(fx.usage(spark, folder)).select("seq", "key")
    routed = topics.routed_records(records, "usage-events", TOPIC_PARTITIONS)
    return topics.record_offsets(routed).select("seq", "key", "topic", "partition", "offset")


@query
def published_records(spark, folder):
    """Two deliveries to a log, the second going on where the first ended; the log afterwards."""
    home = work_folder(spark, "topic-log")
    records = ingest.keyed_records(fx.usage(spark, folder)).select("seq", "key", "value", F.coalesce(F.col("k") < 60, F.lit(False)).alias("early"))
    for early in (True, False):
        publish_in_order(records.where(F.col("early") == early), home, "usage-events", TOPIC_PARTITIONS)
    log = read_log(spark, home)
    return log.select("topic", "partition", "offset", "key", F.get_json_object("value", "$.timestamp").alias("time"))


@query
def status_records(spark, folder):
    """Status records of one successful batch for every event id of the table."""
    transitions = ingest.success_transitions(
        batch_id=7,
        table="lake.usage.events",
        snapshot_id=F.lit(None).cast("string"),
        path="s3a://warehouse/usage/data/",
        bucket="warehouse",
        files=3,
    )
    return ingest.status_records(ingest.batch_event_ids(fx.usage(spark, folder)), transitions)


@query
def sent_records(spark, folder):
    """Status records the gateway writes once the topic has taken an event."""
    log = topics.visible_topics(fx.topic_log(spark, folder), "error_code")
    return ingest.acknowledged_records(log.withColumn("event_id", F.concat(F.lit("evt-"), "event_id")))


@query
def dedup_append(spark, folder):
    """Replaying all usage events, some twice with other content, against the table at an early snapshot."""
    table = history.rows_at(fx.table_rows(spark, folder), fx.commits(spark, folder), fx.EARLY_SNAPSHOT)
    incoming = ingest.parse_events(fx.usage_json_with_repeats(spark, folder), keep=("offset",))
    return ingest.new_rows(incoming, table, order=("offset",)).drop("offset")


# Usage


@query
def usage_rollup(spark, folder):
    columns = ("user_id", "service", "usage_type", "quantity")
    return usage.usage_rollup(ingest.parse_events(fx.usage_json(spark, folder), columns=columns))


@query
def billing_cost(spark, folder):
    columns = ("user_id", "service", "quantity")
    return usage.billing_cost(ingest.parse_events(fx.usage_json(spark, folder), columns=columns))


# Security


@query
def security_parsed(spark, folder):
    parsed = security.readable_events(security.parse_security_events(fx.security_json(spark, folder)))
    return parsed.select(
        "seq", "event_id", F.unix_micros("ets").alias("ets_us"), "event_type", "username", "ip_address", "realm"
    )


@query
def security_rejected(spark, folder):
    skipped = security.unreadable_events(security.parse_security_events(fx.security_json(spark, folder)))
    return skipped.select("seq", "reason")


@query
def failed_logins(spark, folder):
    return security.failed_logins(fx.security(spark, folder)).select(
        "seq", "event_id", "username", "ip_address", F.unix_micros("ets").alias("ets_us")
    )


@query
def bruteforce_incidents(spark, folder):
    return security.bruteforce_incidents(fx.security(spark, folder), window_seconds=INCIDENT_WINDOW_SECONDS)


@query
def risk_scores(spark, folder):
    return security.risk_scores(bruteforce_incidents(spark, folder))


@query
def policy_decisions(spark, folder):
    return security.policy_decisions(risk_scores(spark, folder))


@query
def dry_run_disables(spark, folder):
    return security.dry_run_disables(policy_decisions(spark, folder))


# Pipeline status


def _status(spark, folder, with_extras=True):
    parsed = status.parse_status(fx.status_messages(spark, folder), with_extras=with_extras)
    return status.valid_status(parsed)


@query
def status_parse(spark, folder):
    return _status(spark, folder).select(
        "arrival",
        "event_id",
        "stage",
        "status",
        F.size("extras").alias("extra_fields"),
        *[F.col("extras")[name].alias(name) for name in STATUS_FIELDS],
    )


@query
def status_invalid(spark, folder):
    return status.invalid_status(status.parse_status(fx.status_messages(spark, folder), with_extras=False))


@query
def status_unknown(spark, folder):
    found = status.unknown_status(_status(spark, folder, False), fx.created_events(spark, folder))
    return found.select("arrival", "event_id", "stage", "status")


@query
def pipeline_state(spark, folder):
    return status.pipeline_state(fx.created_events(spark, folder), _status(spark, folder), STATUS_FIELDS)


@query
def pipeline_fields(spark, folder):
    """The open form of the fold: every extra field, one row each."""
    return status.fold_fields(_status(spark, folder))


@query
def pipeline_payload(spark, folder):
    """The open form of the fold with the types of the JSON values."""
    folded = status.fold_payload(status.typed_status(fx.open_status_messages(spark, folder)))
    return folded.drop("field_value")


@query
def pipeline_summary(spark, folder):
    return status.pipeline_summary(fx.created_events(spark, folder), _status(spark, folder, False))


@query
def pipeline_overview(spark, folder):
    return status.pipeline_overview(pipeline_summary(spark, folder))


@query
def pipeline_recent(spark, folder):
    recent = status.recent_events(fx.created_events(spark, folder), _status(spark, folder, False))
    return recent.select("event_id", "touched_arrival", "stage", "status", head_preview(F.col("event_id")).alias("preview"))


@query
def pipeline_retained(spark, folder):
    retained = status.retained_events(fx.created_events(spark, folder), _status(spark, folder, False))
    return retained.select("event_id", "touched_arrival")


@query
def pipeline_retained_late(spark, folder):
    """What is held when some messages come long after their event, and some events are created again."""
    messages = fx.late_messages(_status(spark, folder, False))
    return status.retained_events(fx.events_created_again(spark, folder), messages)


@query
def status_search(spark, folder):
    state = status.pipeline_state(fx.created_events(spark, folder), _status(spark, folder), ("topic",))
    kafka = state.where(F.col("stage") == "kafka").select("event_id", "topic", "status")
    found = status.search_status(kafka, " EVT-12 ", topic="usage-replay")
    return found.select("*", preview(F.col("event_id"), 6).alias("preview"))


@query
def status_normalized(spark, folder):
    words = F.expr(
        """element_at(array('SUCCESS', 'complete', 'Completed', 'running', 'in_progress', 'error', 'FAILED',
                           'queued', 'Pending', 'odd', '', CAST(NULL AS string)), k % 12 + 1)"""
    )
    raw = fx.base_events(spark, folder).select("event_id", words.alias("raw"))
    return raw.select("event_id", "raw", normalized_status(F.col("raw")).alias("state"))


# Table history


def _table(spark, folder):
    return fx.table_rows(spark, folder), fx.commits(spark, folder)


@query
def append_effect(spark, folder):
    return history.append_effect(*_table(spark, folder))


@query
def snapshot_list(spark, folder):
    """The list after a rollback: the head of the branch is given, not the newest snapshot."""
    listed = history.snapshot_list(fx.commits(spark, folder), F.lit(fx.LATE_SNAPSHOT))
    return listed.select(
        F.unix_micros("committed_at").alias("committed_us"),
        "snapshot_id",
        "parent_id",
        "operation",
        F.col("summary")["day"].alias("day"),
        "is_current",
    )


@query
def snapshot_totals(spark, folder):
    return history.snapshot_totals(fx.commits(spark, folder))


@query
def latest_snapshot(spark, folder):
    newest = history.latest_snapshot(fx.commits(spark, folder))
    return newest.select(id_text(F.col("snapshot_id")).alias("snapshot_id"), "operation")


@query
def table_count(spark, folder):
    return history.table_count(*_table(spark, folder))


@query
def time_travel_rows(spark, folder):
    return history.time_travel_rows(*_table(spark, folder), fx.LAST_FULL_SNAPSHOT, 200)


@query
def time_travel_summary(spark, folder):
    return history.time_travel_summary(*_table(spark, folder), fx.LAST_FULL_SNAPSHOT, 200)


@query
def snapshot_compare(spark, folder):
    return history.snapshot_compare(*_table(spark, folder), fx.EARLY_SNAPSHOT)


@query
def snapshot_diff(spark, folder):
    return history.snapshot_diff(*_table(spark, folder), fx.EARLY_SNAPSHOT, fx.LATE_SNAPSHOT)


@query
def table_diff(spark, folder):
    """Rows that differ between two versions of a table whose rows carry no commit; both are partitioned by day."""
    versions = []
    for rows in (fx.daily_usage(spark, folder), fx.changed_usage(spark, folder)):
        home = work_folder(spark, "version")
        columns = [*EVENT_COLUMNS, "day"]
        rows.select(*columns).repartition("day").write.partitionBy("day").parquet(home)
        versions.append(spark.read.schema(rows.select(*columns).schema).parquet(home))
    return compare.table_diff(*versions, bucket="day")


@query
def clear_effect(spark, folder):
    report = history.clear_effect(*_table(spark, folder), fx.CLEAR_SNAPSHOT)
    return report.withColumn("committed_us", F.unix_micros("committed_at")).drop("committed_at")


@query
def reset_effect(spark, folder):
    retained = status.retained_events(fx.created_events(spark, folder), _status(spark, folder, False))
    return history.reset_effect(clear_effect(spark, folder), retained)


# Files


def _paths(folder, *tables):
    return [f"{folder.rstrip('/')}/{table}.parquet" for table in tables]


def _with_file_name(df):
    return df.withColumn("_parquet_file", files.file_name(F.col("_parquet_file"))).drop("_row", "ts")


# Files of other tables are looked through as well; they have no event ids.
_LOOKED_THROUGH = ("customer", "events", "orders")


@query
def parquet_rows_by_event(spark, folder):
    schema = read_table(spark, folder, "events").schema
    return _with_file_name(files.rows_for_event(spark, *_paths(folder, *_LOOKED_THROUGH), event_id="137", schema=schema))


@query
def indexed_rows_by_event(spark, folder):
    """The same lookup in files that are sorted by event id and have Bloom filters of it."""
    home = work_folder(spark, "by-event")
    write_sorted(read_table(spark, folder, "events"), home, "event_id")
    found = files.rows_for_event(spark, home, event_id="137", schema=read_table(spark, folder, "events").schema)
    return found.drop("_parquet_file", "_row", "ts")


@query
def parquet_lookup_report(spark, folder):
    schema = read_table(spark, folder, "events").schema
    report = files.lookup_report(spark, *_paths(folder, *_LOOKED_THROUGH), event_id="137", schema=schema)
    return report.withColumn("files", F.array_join("files", ","))


@query
def parquet_first_rows(spark, folder):
    schema = "n_nationkey long, n_name string, r_regionkey long, r_name string, s_suppkey long, s_name string"
    return _with_file_name(files.first_rows(spark, *_paths(folder, "supplier", "nation", "region"), schema=schema))


@query
def file_row_counts(spark, folder):
    return _with_file_name(files.file_row_counts(spark, *_paths(folder, "events", "nation", "supplier", "orders")))


# Topics


@query
def topic_offsets(spark, folder):
    return topics.sorted_offsets(topics.topic_offsets(topics.visible_topics(fx.topic_log(spark, folder), "error_code")))


@query
def topic_totals(spark, folder):
    log = topics.visible_topics(fx.topic_log(spark, folder), "error_code")
    return topics.topic_totals(topics.topic_offsets(log), "usage-events")


@query
def partition_read(spark, folder):
    return topics.read_partition(fx.topic_log(spark, folder), "usage-events", 1).select(
        "topic", "partition", "offset", "event_id"
    )


# Directory


@query
def claims_projection(spark, folder):
    profile = directory.claims_projection(fx.claims(spark, folder))
    return profile.withColumn("roles", F.array_join("roles", ","))


@query
def admin_users(spark, folder):
    return directory.admin_users(fx.claims(spark, folder))


@query
def directory_list(spark, folder):
    return directory.directory_list(fx.directory_attributes(spark, folder))


@query
def directory_valid(spark, folder):
    return directory.directory_entries(fx.people(spark, folder).drop("realm_roles", "roles"))


def _directory(spark, folder):
    entries = directory.directory_entries(fx.directory_requests(spark, folder))
    present = fx.directory_attributes(spark, folder).select(F.col("uid")[0].alias("uid"))
    return entries, present


@query
def directory_new(spark, folder):
    return directory.new_entries(*_directory(spark, folder))


@query
def directory_duplicates(spark, folder):
    return directory.duplicate_entries(*_directory(spark, folder)).select("seq", "uid")


# Output


@query
def json_safe_rows(spark, folder):
    safe = json_safe(fx.mixed_rows(spark, folder))
    nation = F.map_entries("by_nation")[0]
    return safe.select(
        "s_suppkey",
        F.col("name_bytes").alias("name"),
        "balance",
        "balance_exact",
        "seen_at",
        "seen_on",
        F.col("readings")[0].alias("reading"),
        nation["key"].alias("nation_key"),
        nation["value"]["since"].alias("since"),
        nation["value"]["ok"].alias("ok"),
    )


# Streams: the same inputs and results as the batch queries, through several micro-batches

STREAM_PARTS = 4


def _follow(spark, folder, home, run, *again):
    """Append the events part by part in order of their number and ``run`` on the stream of them after each.

    A part is written by many tasks, as many files; one run takes up the files that are new, wherever the run before it
    stopped. Events without number are in the first part. ``again`` are further parts, delivered after the others.
    """
    events = read_table(spark, folder, "events")
    number = F.col("event_id")
    shares = [i / STREAM_PARTS for i in range(1, STREAM_PARTS)]
    bounds = events.agg(F.percentile_approx(number, shares).alias("b")).first()["b"] or [0] * len(shares)
    parts = [number.isNull() | (number < bounds[0])]
    parts += [(number >= low) & (number < high) for low, high in zip(bounds, bounds[1:])] + [number >= bounds[-1]]
    for part in [*parts, *again]:
        events.where(part).repartitionByRange("event_id").write.mode("append").parquet(f"{home}/events")
        run(fx.with_k(readers.file_stream(spark, f"{home}/events", events.schema)))


@query
def stream_ingest(spark, folder):
    """Usage records through the ingest pipeline; the table afterwards."""
    home = work_folder(spark, "stream-ingest")
    table = BatchTable(spark, f"{home}/table").create()
    handler = pipeline.batch_handler(pipeline.parquet_target(table), parquet_publisher(f"{home}/status"))

    def run(events):
        readers.run_available(ingest.parse_events(fx.usage_json_of(events)), handler, f"{home}/checkpoint")

    _follow(spark, folder, home, run)
    return table.current()


@query
def stream_receipts(spark, folder):
    """What the batches of the ingest pipeline say they wrote, added up; no written row is read again."""
    home = work_folder(spark, "stream-receipts")
    table = BatchTable(spark, f"{home}/table").create()
    written = []
    target = pipeline.parquet_target(table, receipt=written.append)
    handler = pipeline.batch_handler(target, parquet_publisher(f"{home}/status"))

    def run(events):
        readers.run_available(ingest.parse_events(fx.usage_json_of(events)), handler, f"{home}/checkpoint")

    _follow(spark, folder, home, run)
    # One row a batch, of which there are STREAM_PARTS.
    schema = "batch_id bigint, rows bigint, without_id bigint, first_id string, last_id string, files bigint"
    receipts = spark.createDataFrame([vars(w) for w in written], schema)
    return receipts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("without_id"), F.lit(0)).alias("without_id"),
        F.min("first_id").alias("first_id"),
        F.max("last_id").alias("last_id"),
    )


@query
def stream_dedup(spark, folder):
    """Usage records of which a third are delivered again after the last of them; the table afterwards."""
    home = work_folder(spark, "stream-dedup")
    table = BatchTable(spark, f"{home}/table").create()

    def run(events):
        once = dedup.once_only(ingest.parse_events(fx.usage_json_of(events)), delay="5 days")
        readers.run_available(once, table.append, f"{home}/checkpoint")

    _follow(spark, folder, home, run, F.col("event_id") % 3 == 0)
    return table.current()


@query
def stream_incidents(spark, folder):
    """Security records through the stateful detector."""
    home = work_folder(spark, "stream-incidents")

    def emit(incidents, batch_id):
        incidents.write.mode("overwrite").parquet(f"{home}/incidents/batch={batch_id}")

    def run(events):
        found = detector.incident_stream(fx.security_of(events), window_seconds=INCIDENT_WINDOW_SECONDS)
        with detector.rocksdb(spark):
            readers.run_available(found, emit, f"{home}/checkpoint")

    _follow(spark, folder, home, run)
    return spark.read.schema(detector.INCIDENT_SCHEMA).parquet(f"{home}/incidents").drop("batch")


@query
def stream_incidents_idle(spark, folder):
    """The same with the state of users dropped who are idle for four days; late events have a day."""
    home = work_folder(spark, "stream-idle")

    def emit(incidents, batch_id):
        incidents.write.mode("overwrite").parquet(f"{home}/incidents/batch={batch_id}")

    def run(events):
        found = detector.incident_stream(fx.security_of(events), window_seconds=INCIDENT_WINDOW_SECONDS, idle_seconds=4 * 24 * 3600, delay="1 day")
        with detector.rocksdb(spark):
            readers.run_available(found, emit, f"{home}/checkpoint")

    _follow(spark, folder, home, run)
    return spark.read.schema(detector.INCIDENT_SCHEMA).parquet(f"{home}/incidents").drop("batch")


@query
def stream_pipeline_state(spark, folder):
    """Status records through the streaming fold, joined to the created events; the state is read from its store."""
    home = work_folder(spark, "stream-status")
    _follow(spark, folder, home, lambda events: status_state.keep_state(status_state.field_stream(fx.status_messages_of(events)), f"{home}/checkpoint"))
    folded = status.stages_from_fields(status_state.fields_of_state(spark, f"{home}/checkpoint"), STATUS_FIELDS)
    return status.with_initial_state(fx.created_events(spark, folder), folded)
