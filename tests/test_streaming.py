import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventlake.operators import ingest, security, status
from eventlake.plans import fixtures as fx
from eventlake.sinks.batches import BatchTable
from eventlake.sinks.topics import best_effort, parquet_publisher
from eventlake.streaming import dedup, detector, pipeline, readers, status_state

SMALL = "/root/testdata/sf0.001"
WINDOW = 3 * 24 * 3600


def write_parts(df, folder, order, parts):
    """One file per range of ``order``, with growing modification times."""
    df = df.persist()
    low, high = df.agg(F.min(order), F.max(order)).first()
    step = (high - low) // parts + 1
    for i in range(parts):
        part = df.where((F.col(order) >= low + i * step) & (F.col(order) < low + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(folder)
        now = time.time() - 1000 + i * 10
        for name in os.listdir(folder):
            path = f"{folder}/{name}"
            if name.endswith(".parquet") and os.path.getmtime(path) > now + 20:
                os.utime(path, (now, now))
    return df.schema


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_incidents_over_batches_equal_the_batch_job(spark, folder):
    events = fx.security(spark, SMALL)
    schema = write_parts(events, f"{folder}/in", "seq", 4)
    seen = []

    def emit(incidents, batch_id):
        seen.append(batch_id)
        incidents.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    stream = readers.file_stream(spark, f"{folder}/in", schema, 1)
    with detector.rocksdb(spark):
        readers.run_available(detector.incident_stream(stream, 3, WINDOW), emit, f"{folder}/checkpoint")
    assert seen == [0, 1, 2, 3]
    got = spark.read.parquet(f"{folder}/out").drop("batch")
    want = security.bruteforce_incidents(events, 3, WINDOW)
    assert rows(got) == rows(want) and want.count() > 3


def test_a_failed_batch_finds_the_state_it_started_from(spark, folder):
    events = fx.security(spark, SMALL)
    schema = write_parts(events, f"{folder}/in", "seq", 3)
    fails = [True]

    def emit(incidents, batch_id):
        if batch_id == 2 and fails:
            fails.clear()
            raise OSError("sink is down")
        incidents.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    def run():
        stream = readers.file_stream(spark, f"{folder}/in", schema, 1)
        with detector.rocksdb(spark):
            readers.run_available(detector.incident_stream(stream, 3, WINDOW), emit, f"{folder}/checkpoint")

    with pytest.raises(Exception, match="sink is down"):
        run()
    run()
    got = spark.read.parquet(f"{folder}/out").drop("batch")
    assert rows(got) == rows(security.bruteforce_incidents(events, 3, WINDOW))


def test_status_over_batches_equals_the_batch_job(spark, folder):
    messages = fx.status_messages(spark, SMALL)
    schema = write_parts(messages, f"{folder}/in", "arrival", 3)

    def source():
        return readers.file_stream(spark, f"{folder}/in", schema, 1)

    keep = status_state.update_handler(f"{folder}/state")
    readers.run_available(status_state.field_stream(source()), keep, f"{folder}/checkpoint", mode="update")
    publish = parquet_publisher(f"{folder}/rejected")
    readers.run_available(status_state.rejected_stream(source()), lambda df, _: publish(df), f"{folder}/checkpoint-rejected")
    created = fx.created_events(spark, SMALL)
    fields = ("batch_id", "snapshot_id")
    folded = status.stages_from_fields(status_state.read_state(spark, f"{folder}/state"), fields)
    parsed = status.parse_status(messages)
    assert rows(status.with_initial_state(created, folded)) == rows(
        status.pipeline_state(created, status.valid_status(parsed), fields)
    )
    assert spark.read.parquet(f"{folder}/rejected").count() == status.invalid_status(parsed).count()


def test_a_batch_of_changes_that_runs_again_counts_once(spark, folder):
    keep = status_state.update_handler(folder)
    first = spark.createDataFrame([("e", "spark", "status", "processing", 1)], status_state.FIELD_SCHEMA)
    second = spark.createDataFrame([("e", "spark", "status", "completed", 2)], status_state.FIELD_SCHEMA)
    for batch_id, changes in ((0, first), (1, second), (1, second), (0, first)):
        keep(changes, batch_id)
    assert [tuple(r) for r in status_state.read_state(spark, folder).collect()] == [("e", "spark", "status", "completed", 2)]


def usage_records(spark, *ids):
    return spark.createDataFrame([(json.dumps({"event_id": i, "quantity": 1}),) for i in ids], "value string")


def published(spark, folder):
    log = spark.read.parquet(folder).orderBy("published_at").collect()
    return [(r.key, json.loads(r.value)) for r in log]


def test_ingest_resumes_and_readers_are_independent(spark, folder):
    usage_records(spark, "a", "b").coalesce(1).write.parquet(f"{folder}/in")
    table = BatchTable(spark, f"{folder}/table").create()
    handler = pipeline.batch_handler(pipeline.parquet_target(table, "warehouse"), parquet_publisher(f"{folder}/status"))

    def run(name="ingest", to=handler):
        stream = ingest.parse_events(readers.file_stream(spark, f"{folder}/in", usage_records(spark, "a").schema))
        readers.run_available(stream, to, f"{folder}/checkpoint-{name}")

    run()
    usage_records(spark, "c").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run()
    run()
    assert sorted(r.event_id for r in table.current().collect()) == ["a", "b", "c"]

    other = []
    run("billing", lambda df, _: other.extend(r.event_id for r in df.collect()))
    assert sorted(other) == ["a", "b", "c"]

    log = [(v["stage"], v["status"]) for k, v in published(spark, f"{folder}/status") if k == "a"]
    assert log == [
        ("spark", "completed"),
        ("iceberg", "processing"),
        ("iceberg", "completed"),
        ("minio", "processing"),
        ("minio", "completed"),
    ]
    final = [v for k, v in published(spark, f"{folder}/status") if k == "c"]
    assert final[2]["snapshot_id"] == "1" and final[2]["batch_id"] == 1
    assert final[4]["parquet_files"] >= 1 and final[4]["bucket"] == "warehouse"


def test_receipts_come_from_the_writing_job(spark, folder):
    """Figures of each batch equal its partition, and after the write no job reads or lists anything."""
    table, written = BatchTable(spark, f"{folder}/table").create(), []
    target = pipeline.parquet_target(table, receipt=written.append)
    records = ingest.parse_events(usage_records(spark, *[f"e{n:03d}" for n in range(41)]))
    records = records.withColumn("event_id", F.nullif("event_id", F.lit("e040")))
    for batch_id, parts in ((3, 4), (4, 1), (3, 2)):
        target.append(records.repartition(parts), batch_id)
        tracker = spark.sparkContext.statusTracker()
        before = len(tracker.getJobIdsForGroup())
        assert target.count_files(str(batch_id)) == parts
        assert len(tracker.getJobIdsForGroup()) == before
        part = table.rows().where(F.col("batch_id") == batch_id)
        last = written[-1]
        assert (last.batch_id, last.rows, last.without_id, last.first_id, last.last_id) == (batch_id, 41, 1, "e000", "e039")
        assert part.count() == 41 and part.select(F.input_file_name()).distinct().count() == last.files
    empty = table.append_counted(records.where("false"), 9)
    assert (empty.rows, empty.without_id, empty.first_id, empty.files) == (0, 0, None, 0)


def failing(*_):
    raise OSError("store is down")


def test_failed_append_is_reported_and_raised(spark, folder):
    target = pipeline.Target("t", "b", "p", failing, lambda _: 1)
    handler = pipeline.batch_handler(target, parquet_publisher(folder))
    with pytest.raises(OSError):
        handler(ingest.parse_events(usage_records(spark, "a")), 4)
    log = [v for _, v in published(spark, folder)]
    assert [(v["stage"], v["status"]) for v in log][-2:] == [("iceberg", "failed"), ("spark", "failed")]
    assert log[-1]["error"] == "store is down" and log[-1]["batch_id"] == 4


def test_missing_files_fail_the_batch_after_the_append(spark, folder):
    appended = []
    target = pipeline.Target("t", "b", "p", lambda df, n: appended.append(df.count()), lambda _: 0)
    handler = pipeline.batch_handler(target, parquet_publisher(folder))
    with pytest.raises(RuntimeError):
        handler(ingest.parse_events(usage_records(spark, "a")), 0)
    assert appended == [1]
    last = published(spark, folder)[-1][1]
    assert (last["stage"], last["status"], last["path"]) == ("minio", "failed", "p")
    completed = [v for _, v in published(spark, folder) if (v["stage"], v["status"]) == ("iceberg", "completed")]
    assert completed[0]["snapshot_id"] is None


def test_status_outage_does_not_fail_the_batch(spark, folder):
    table = BatchTable(spark, folder).create()
    for replace, count in ((True, 1), (False, 3)):
        handler = pipeline.batch_handler(pipeline.parquet_target(table, replace=replace), failing)
        for _ in range(2):
            handler(ingest.parse_events(usage_records(spark, "a")), 0)
        assert table.current().count() == count
    best_effort(failing)(None)


def test_empty_batches_are_skipped(spark):
    handler = pipeline.batch_handler(pipeline.Target("t", "b", "p", failing, failing), failing)
    events = ingest.parse_events(usage_records(spark, "a"))
    handler(events.where("false"), 0)
    handler(events.withColumn("event_id", F.lit(None).cast("string")), 1)


def test_state_is_read_from_its_store(spark, folder):
    messages = fx.status_messages(spark, SMALL)
    schema = write_parts(messages, f"{folder}/in", "arrival", 3)
    stream = status_state.field_stream(readers.file_stream(spark, f"{folder}/in", schema, 1))
    status_state.keep_state(stream, f"{folder}/checkpoint")
    got = status_state.fields_of_state(spark, f"{folder}/checkpoint").select("event_id", "stage", "field", "field_value", "arrival")
    assert rows(got) == rows(status.fold_fields(status.valid_status(status.parse_status(messages))))


def test_state_has_the_latest_versions_only(spark, folder):
    """Batches over the same keys: what the store holds does not grow with them."""
    sizes = []
    for batch in range(12):
        messages = [(100 * batch + i, json.dumps({"event_id": f"e{i}", "stage": "s", "status": f"x{batch}"})) for i in range(50)]
        spark.createDataFrame(messages, "arrival long, value string").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = status_state.field_stream(readers.file_stream(spark, f"{folder}/in", "arrival long, value string"))
        status_state.keep_state(stream, f"{folder}/checkpoint")
        sizes.append(status_state.fields_of_state(spark, f"{folder}/checkpoint").count())
    assert sizes == [50] * 12
    state = status_state.fields_of_state(spark, f"{folder}/checkpoint")
    assert {r.field_value for r in state.collect()} == {"x11"}


def test_the_state_is_not_held_in_the_heap(spark, folder):
    """The checkpoint is one of RocksDB, and the session's own settings are as before."""
    names = ["spark.sql.streaming.stateStore.providerClass", status_state.RETAINED_VERSIONS, *status_state.STORE_SETTINGS]
    before = [spark.conf.get(name, None) for name in names]
    messages = [(i, json.dumps({"event_id": f"e{i}", "stage": "s", "status": "x"})) for i in range(20)]
    spark.createDataFrame(messages, "arrival long, value string").write.parquet(f"{folder}/in")
    stream = status_state.field_stream(readers.file_stream(spark, f"{folder}/in", "arrival long, value string"))
    status_state.keep_state(stream, f"{folder}/checkpoint")
    kinds = {path.suffix for path in Path(f"{folder}/checkpoint/state/0").glob("[0-9]*/*") if not path.name.startswith(".")}
    assert ".zip" in kinds and ".delta" not in kinds
    assert status_state.fields_of_state(spark, f"{folder}/checkpoint").count() == 20
    assert [spark.conf.get(name, None) for name in names] == before


def dated(spark, *rows):
    return spark.createDataFrame([(i, f"2024-01-01T{hour:02}:00:00.000000+00:00") for i, hour in rows], "event_id string, timestamp string").coalesce(1)


def test_replays_over_a_restart_add_nothing(spark, folder):
    seen = []

    def run():
        stream = readers.file_stream(spark, f"{folder}/in", dated(spark).schema)
        readers.run_available(dedup.once_only(stream, delay="2 hours"), lambda df, _: seen.extend(r.event_id for r in df.collect()), f"{folder}/checkpoint")

    for part in ([("a", 1), ("b", 2), ("a", 1)], [("b", 2), ("c", 3)], [("a", 1), ("d", 9)], [("a", 1), ("c", 3), ("e", 8)], [(None, 9), ("f", 10)]):
        dated(spark, *part).write.mode("append").parquet(f"{folder}/in")
        run()
    assert sorted(seen) == ["a", "b", "c", "d", "e", "f"]


def test_seen_keys_leave_the_state_behind_the_watermark(spark, folder):
    for hour in range(1, 9):
        dated(spark, *[(f"{hour}-{i}", hour) for i in range(20)]).write.mode("append").parquet(f"{folder}/in")
        stream = readers.file_stream(spark, f"{folder}/in", dated(spark).schema)
        readers.run_available(dedup.once_only(stream, delay="2 hours"), lambda df, _: df.count(), f"{folder}/checkpoint")
    held = spark.read.format("statestore").load(f"{folder}/checkpoint").count()
    assert 0 < held <= 4 * 20


def attempts(spark, *rows):
    made = spark.createDataFrame([(seq, user, minute) for seq, user, minute in rows], "seq long, username string, minute long")
    return made.select(
        "seq", "username", F.timestamp_seconds(1_700_000_000 + F.col("minute") * 60).alias("ets"), F.lit("LOGIN_FAILED").alias("event_type"),
        F.lit("1.2.3.4").alias("ip_address"), F.lit("c").alias("client_id"), F.lit("r").alias("realm"),
    ).coalesce(1)


def state_rows(spark, checkpoint):
    reader = spark.read.format("statestore").option("stateVarName", "highs").option("flattenCollectionTypes", True)
    return reader.load(checkpoint).count()


@pytest.mark.parametrize("idle", [None, 600])
def test_idle_users_leave_the_state(spark, folder, idle):
    """Bursts of two users, long silence, then another user's events: incidents as in the batch job, with and without expiry."""
    parts = [
        [(i, "a", i % 7) for i in range(30)] + [(30 + i, "b", 3) for i in range(10)],
        [(100 + i, "a", 8 + i % 3) for i in range(20)],
        [(200, "c", 300)],
        [(300 + i, "c", 600) for i in range(4)] + [(310, "a", 600)],
    ]
    sizes, everything = [], []
    for part in parts:
        everything += part
        attempts(spark, *part).write.mode("append").parquet(f"{folder}/in")
        stream = readers.file_stream(spark, f"{folder}/in", attempts(spark).schema)
        found = detector.incident_stream(stream, 3, 300, idle, "30 minutes")
        with detector.rocksdb(spark):
            readers.run_available(found, lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/out/batch={n}"), f"{folder}/checkpoint")
            sizes.append(state_rows(spark, f"{folder}/checkpoint"))
    got = spark.read.schema(detector.INCIDENT_SCHEMA).parquet(f"{folder}/out").drop("batch")
    want = security.bruteforce_incidents(attempts(spark, *everything), 3, 300)
    assert rows(got) == rows(want) and want.count() > 20
    if idle is None:
        assert sizes[2] > sizes[0] // 2
    else:
        assert sizes[1] > 5 and sizes[2] == 1


def test_idle_time_is_not_below_the_window(spark):
    with pytest.raises(ValueError):
        detector.incident_stream(spark.range(1), 3, 300, 60)
