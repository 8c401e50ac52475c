import json

from pyspark.sql import functions as F

from eventlake.operators import directory, ingest, topics, usage
from eventlake.schemas import EVENT_COLUMNS, EVENT_SCHEMA
from eventlake.sources import kafka


def parse(spark, *values):
    return ingest.parse_events(spark.createDataFrame([(v,) for v in values], "value string"))


def test_parsing_keeps_what_can_be_read(spark):
    got = parse(
        spark,
        '{"event_id":"a","quantity":3,"extra":1}',
        '{"event_id":"b","quantity":"5"}',
        '{"event_id":"c","quantity":5.0}',
        '{"event_id":"d","quantity":3000000000}',
        '{"event_id":"e","service":{"x":1},"quantity":-4}',
        '{"event_id":"","quantity":1}',
        '{"event_id":"f","event_id":"g"}',
        '{"Event_Id":"h"}',
        '{"event_id":null}',
        "{bad",
        "null",
        "[]",
        None,
    )
    assert got.columns == EVENT_COLUMNS
    rows = {r.event_id: (r.quantity, r.service) for r in got.collect()}
    assert rows == {
        "a": (3, None),
        "b": (None, None),
        "c": (None, None),
        "d": (None, None),
        "e": (-4, '{"x":1}'),
        "": (1, None),
        "g": (None, None),
    }


def test_binary_values_parse_like_text(spark):
    df = spark.createDataFrame([(b'{"event_id":"a"}',)], "value binary")
    assert ingest.parse_events(df).first().event_id == "a"


def test_topic_records_decode(spark):
    df = spark.createDataFrame([(None, b"v"), (b"k", "글".encode())], "key binary, value binary")
    assert [tuple(r) for r in kafka.decoded(df).collect()] == [(None, "v"), ("k", "글")]


SAMPLE = [
    ("u1", "api", "request", 10),
    ("u1", "search", "request", 5),
    ("u1", "storage", "gb", 20),
    ("u2", "api", "request", 30),
    ("u2", "search", "request", 15),
    ("u3", "api", "request", 50),
]


def test_sample_totals_and_cost(spark):
    df = spark.createDataFrame([*SAMPLE, ("u3", "api", "request", None)], "user_id string, service string, usage_type string, quantity int")
    cost = usage.billing_cost(df).groupBy("user_id").agg(F.sum("quantity"), F.sum("cost")).collect()
    assert {r[0]: (r[1], r[2]) for r in cost} == {"u1": (35, 3500), "u2": (45, 4500), "u3": (50, 5000)}
    assert usage.usage_rollup(df).count() == 6


def test_sample_without_ids_is_dropped(spark):
    bodies = [json.dumps(dict(zip(("user_id", "service", "usage_type", "quantity"), r))) for r in SAMPLE]
    assert parse(spark, *bodies).isEmpty()


def test_requests_are_accepted_or_rejected_once(spark):
    rows = [("s", "t", 1), ("", "t", 1), ("s", None, 1), ("s", "t", 0), ("", "", None), ("s", "t", None), (" ", "t", 2)]
    df = spark.createDataFrame(rows, "service string, usage_type string, quantity int")
    assert {tuple(r) for r in ingest.accepted_requests(df).collect()} == {("s", "t", 1), (" ", "t", 2)}
    reasons = sorted(r.reason for r in ingest.rejected_requests(df).collect())
    assert reasons == ["quantity", "quantity", "service", "service,usage_type,quantity", "usage_type"]


def test_envelope_fills_id_type_and_time(spark):
    df = spark.createDataFrame([("u", "n", "s", "t", 2)] * 2, "user_id string, username string, service string, usage_type string, quantity long")
    events = ingest.usage_envelope(df)
    assert events.schema.simpleString() == EVENT_SCHEMA.simpleString()
    rows = events.collect()
    assert rows[0].event_id != rows[1].event_id and len(rows[0].event_id) == 36
    assert rows[0].event_type == "usage" and rows[0].timestamp.endswith("+00:00") and len(rows[0].timestamp) == 32


def test_records_round_trip(spark):
    events = parse(spark, '{"event_id":"a","user_id":"u","service":"검색","quantity":1}')
    record = ingest.keyed_records(events).first()
    assert record.key == "u" and "검색" in record.value and '"username":null' in record.value
    again = parse(spark, record.value)
    assert again.collect() == events.collect()


def test_new_rows(spark):
    incoming = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "event_id string")
    table = spark.createDataFrame([("a",), ("z",)], "event_id string")
    assert [r.event_id for r in ingest.new_rows(incoming, table).collect()] == ["b"]


def test_new_rows_choose_by_the_order(spark):
    rows = [("a", 3, 0), ("a", 1, 5), ("a", 2, 1), ("b", None, 9), ("b", None, 2)]
    table = spark.createDataFrame([], "event_id string")
    for copies in (rows, rows[::-1]):
        incoming = spark.createDataFrame(copies, "event_id string, at int, v int")
        assert sorted(map(tuple, ingest.new_rows(incoming, table, order=["at"]).collect())) == [("a", 1, 5), ("b", None, 2)]


def test_only_the_named_fields_are_parsed(spark):
    records = spark.createDataFrame([(1, '{"event_id":"a","quantity":2,"service":"s"}'), (2, "{bad")], "offset int, value string")
    parsed = ingest.parse_events(records, columns=("quantity",), keep=("offset",))
    assert [tuple(r) for r in parsed.collect()] == [(2, 1)]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "quantity" in plan and "usage_type" not in plan


def test_offsets(spark):
    log = spark.createDataFrame([("t", 0, 5), ("t", 0, 7), ("t", 1, 3), ("__x", 0, 0), ("", 0, 1), ("e", 0, 1)], "topic string, partition int, offset long")
    log = log.withColumn("err", F.when(F.col("topic") == "e", 3))
    ranges = topics.topic_offsets(topics.visible_topics(log, "err"))
    assert [tuple(r) for r in topics.sorted_offsets(ranges).collect()] == [("t", 0, 5, 8, 3), ("t", 1, 3, 4, 1)]
    assert tuple(topics.topic_totals(ranges).first()) == (1, 2, 4)
    assert tuple(topics.topic_totals(ranges, "other").first()) == (1, 2, 0)
    ends = spark.createDataFrame([(5, 3), (None, 3), (2, 9)], "b long, e long")
    assert [r[0] for r in ends.select(topics.log_size(F.col("b"), F.col("e"))).collect()] == [0, None, 7]
    assert topics.read_partition(log, "t", 0, 6).count() == 1


def test_directory_requests(spark):
    rows = [
        (1, "ada", " Ada  Lovelace ", "a@x", " "),
        (2, "ab", "A", "a@x", ""),
        (3, "bad name", "A", "a@x", ""),
        (4, "newline\n", "A", "a@x", ""),
        (5, "solo", "Solo", "a@x", None),
        (6, "blank", "\t ", "a@x", ""),
        (7, "ada", "Other", "b@x", "Lab"),
        (8, "taken", "T", "t@x", "Lab"),
        (9, "mail", "M", "m", ""),
    ]
    df = spark.createDataFrame(rows, "seq long, username string, full_name string, email string, department string")
    entries = directory.directory_entries(df)
    got = {r.seq: (r.cn, r.givenName, r.sn, r.departmentNumber) for r in entries.collect()}
    assert got == {
        1: ("Ada  Lovelace", "Ada", "Lovelace", None),
        5: ("Solo", "Solo", "Solo", None),
        7: ("Other", "Other", "Other", "Lab"),
        8: ("T", "T", "T", "Lab"),
    }
    present = spark.createDataFrame([("taken",), ("taken",)], "uid string")
    assert sorted(r.seq for r in directory.new_entries(entries, present).collect()) == [1, 5]
    assert sorted(r.seq for r in directory.duplicate_entries(entries, present).collect()) == [7, 8]


def test_roles(spark):
    rows = [("a", (["ldap-admin"],), None), ("b", None, ["data-admin"]), ("c", (None,), None), ("d", (["user"],), [])]
    df = spark.createDataFrame(rows, "preferred_username string, realm_access struct<roles: array<string>>, roles array<string>")
    df = df.withColumns({"sub": F.lit("s"), "email": F.lit(None).cast("string"), "name": F.lit("n")})
    assert {r.username: r.is_ldap_admin for r in directory.admin_users(df).collect()} == {"a": True, "b": False}
    assert {r.username: r.roles for r in directory.claims_projection(df).collect()} == {"a": ["ldap-admin"], "b": [], "c": [], "d": ["user"]}
