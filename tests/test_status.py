import json

import pytest
from pyspark.sql import functions as F

from eventlake.operators import status


def messages(spark, *payloads):
    rows = [(i, p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "arrival long, value string")


def events(spark, *ids):
    return spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "event_id string, created_arrival long")


def msg(event_id, stage, state, **extra):
    return {"event_id": event_id, "stage": stage, "status": state, **extra}


def state_of(spark, ids, *payloads, fields=()):
    parsed = status.valid_status(status.parse_status(messages(spark, *payloads)))
    rows = status.pipeline_state(events(spark, *ids), parsed, fields).collect()
    return {(r.event_id, r.stage): r for r in rows}


def test_new_events_start_in_the_initial_state(spark):
    state = state_of(spark, ["a"])
    assert {stage: r.status for (_, stage), r in state.items()} == {
        "fastapi": "completed",
        "kafka": "processing",
        "spark": "waiting",
        "iceberg": "waiting",
        "minio": "waiting",
    }


def test_fields_merge_one_by_one(spark):
    state = state_of(
        spark,
        ["a"],
        msg("a", "iceberg", "completed", snapshot_id="9", batch_id=1),
        msg("a", "iceberg", "processing", batch_id=2),
        msg("a", "iceberg", "completed", snapshot_id=None),
        msg("a", "minio", "completed", path="p"),
        msg("a", "minio", "failed"),
        fields=("batch_id", "snapshot_id", "path"),
    )
    iceberg, minio = state["a", "iceberg"], state["a", "minio"]
    assert (iceberg.status, iceberg.batch_id, iceberg.snapshot_id) == ("completed", "2", None)
    assert iceberg.updated_arrival == 2
    assert (minio.status, minio.path) == ("failed", "p")


def test_last_arrival_wins_and_no_status_outranks_another(spark):
    state = state_of(spark, ["a"], msg("a", "spark", "completed"), msg("a", "spark", "processing"))
    assert state["a", "spark"].status == "processing"


def test_stages_appear_on_demand_and_unknown_events_do_not(spark):
    state = state_of(spark, ["a"], msg("a", "archive", "completed"), msg("ghost", "spark", "completed"))
    assert state["a", "archive"].status == "completed"
    assert len(state) == 6 and not any(e == "ghost" for e, _ in state)


def test_unusable_messages_are_reported(spark):
    parsed = status.parse_status(
        messages(spark, "{bad", "null", "[1]", None, {"event_id": "a"}, msg("a", "", "x"), msg("a", "s", "ok", n=1))
    )
    assert [r.arrival for r in status.valid_status(parsed).collect()] == [6]
    assert sorted(r.arrival for r in status.invalid_status(parsed).collect()) == [0, 1, 2, 3, 4, 5]
    assert status.valid_status(parsed).first().extras == {"n": "1"}


def test_unknown_status_keeps_every_row_of_a_busy_id(spark):
    rows = spark.range(1000).select(
        F.col("id").alias("arrival"),
        F.when(F.col("id") % 3 == 0, "ghost").otherwise(F.concat(F.lit("e"), F.col("id") % 20)).alias("event_id"),
    )
    known = events(spark, *[f"e{i}" for i in range(10)])
    got = status.unknown_status(rows, known)
    assert got.count() == rows.where("event_id = 'ghost' OR CAST(substring(event_id, 2) AS int) >= 10").count()
    assert got.where("event_id = 'ghost'").count() == 334


def test_a_busy_id_is_cut_into_pieces(spark):
    """With thresholds small enough for test data, the skewed partition of the anti join is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    rows = spark.range(0, 60_000, 1, 12).select(
        F.col("id").alias("arrival"),
        F.when(F.col("id") % 3 == 0, "ghost").otherwise(F.concat(F.lit("e"), F.col("id"))).alias("event_id"),
    )
    known = spark.range(60_000).select(F.concat(F.lit("e"), F.col("id")).alias("event_id"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = status.unknown_status(rows, known)
        assert len(got.collect()) == 20_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_summary_and_overview(spark):
    stages = ("kafka", "spark", "iceberg", "minio")
    payloads = [msg("done", s, "completed") for s in stages]
    payloads += [msg("bad", "kafka", "failed"), msg("bad", "spark", "completed")]
    parsed = status.valid_status(status.parse_status(messages(spark, *payloads)))
    summary = status.pipeline_summary(events(spark, "done", "bad", "new"), parsed)
    rows = {r.event_id: (r.overall_status, r.completed_stages, r.failed_stages, r.total_stages) for r in summary.collect()}
    assert rows == {"done": ("completed", 5, 0, 5), "bad": ("failed", 2, 1, 5), "new": ("processing", 1, 0, 5)}
    assert tuple(status.pipeline_overview(summary).first()) == (3, 1, 1)


def test_folding_in_two_parts_equals_folding_at_once(spark):
    payloads = [
        msg(f"e{i % 7}", ("spark", "minio")[i % 2], f"s{i}", **({"f": i} if i % 3 else {"f": None, "g": i}))
        for i in range(60)
    ]
    parsed = status.valid_status(status.parse_status(messages(spark, *payloads)))
    parts = [status.fold_fields(parsed.where(cut)) for cut in ("arrival < 25", "arrival >= 25")]
    merged = status.merge_fields(parts[1].unionByName(parts[0]))
    whole = status.fold_fields(parsed)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
    wide = status.stages_from_fields(whole, ("f", "g"))
    direct = status.fold_stages(parsed, ("f", "g"))
    assert wide.exceptAll(direct).isEmpty() and direct.exceptAll(wide).isEmpty()
    documents = {(r.event_id, r.stage): r.document for r in status.stage_documents(whole).collect()}
    assert documents["e0", "spark"]["status"] == "s56"


@pytest.mark.parametrize(("asked", "given"), [(0, 1), (3, 3), (500, 5)])
def test_recent_limit_is_clamped(spark, asked, given):
    ids = [f"e{i}" for i in range(9)]
    parsed = status.valid_status(status.parse_status(messages(spark, *[msg(i, "spark", "completed") for i in ids[:2]])))
    recent = status.recent_events(events(spark, *ids), parsed, asked, keep=5)
    assert recent.select("event_id").distinct().count() == given
    newest = recent.orderBy(F.desc("touched_arrival")).first()
    assert newest.event_id == "e8"


def test_one_event(spark):
    state = spark.createDataFrame([("a", "spark")], "event_id string, stage string")
    assert status.event_state(state, "a").count() == 1
    with pytest.raises(LookupError):
        status.event_state(state, "b")


def test_search(spark):
    state = spark.createDataFrame(
        [("Evt-1", "usage"), ("evt-2", "Replay"), ("x", None)], "event_id string, topic string"
    )

    def ids(*args, **kwargs):
        return sorted(r.event_id for r in status.search_status(state, *args, **kwargs).collect())

    assert ids(" EVT ") == ["Evt-1", "evt-2"]
    assert ids(" EVT ", trim=False) == []
    assert ids("replay") == ["evt-2"]
    assert ids("", topic="usage") == ["Evt-1"]
    assert ids("") == ["Evt-1", "evt-2", "x"]
