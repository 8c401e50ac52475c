"""Comparison of table versions, files for lookups, typed payloads."""

import json
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlake.operators import compare, status
from eventlake.sinks.batches import BatchTable
from eventlake.sinks.lookups import write_sorted
from eventlake.sources import files


def scan_rows(df):
    """Rows that the file scans of an executed frame put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            waiting.append(node.executedPlan())
            continue
        if "QueryStage" in name or name.startswith(("ShuffleQueryStage", "TableCacheQueryStage")):
            waiting.append(node.plan())
            continue
        if name.startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return sum(found)


def except_all(left, right):
    more = Counter(left)
    more.subtract(Counter(right))
    return {(("removed" if n > 0 else "added"), *row, abs(n)) for row, n in more.items() if n}


@pytest.mark.parametrize("bucket, buckets", [(None, 1), (None, 64), ("a", 1)])
def test_diff_equals_except_all_both_ways(spark, bucket, buckets):
    draw = random.Random(2)
    make = lambda: [(draw.choice([None, 1, 2, 3]), draw.choice([None, "x", "y", ""]), draw.choice([0.5, None])) for _ in range(300)]
    left, right = make(), make()
    schema = "a int, b string, c double"
    got = compare.table_diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), bucket, buckets)
    assert {tuple(r) for r in got.collect()} == except_all(left, right)


def test_a_null_is_not_another_column_s_value(spark):
    left = spark.createDataFrame([("x", None)], "a string, b string")
    right = spark.createDataFrame([(None, "x")], "a string, b string")
    assert compare.table_diff(left, right).count() == 2


def test_equal_tables_and_empty_ones(spark):
    rows = spark.range(100).selectExpr("id % 7 AS a", "'t' AS b")
    assert compare.table_diff(rows, rows.orderBy(F.desc("a"))).count() == 0
    assert compare.table_diff(rows.limit(0), rows.limit(0)).count() == 0
    assert compare.table_diff(rows, rows.limit(0)).agg(F.sum("copies")).first()[0] == 100


def test_equal_buckets_are_not_read_again(spark, folder):
    rows = spark.range(4000).selectExpr("id", "CAST(id % 40 AS int) AS day")
    rows.write.partitionBy("day").parquet(f"{folder}/a")
    rows.where("id <> 77").write.partitionBy("day").parquet(f"{folder}/b")
    versions = [spark.read.schema(rows.schema).parquet(f"{folder}/{v}") for v in "ab"]
    diff = compare.table_diff(*versions, bucket="day")
    assert [tuple(r) for r in diff.collect()] == [("removed", 77, 37, 1)]
    assert scan_rows(diff) == 199


def test_a_lookup_in_sorted_files_skips_row_groups(spark, folder):
    rows = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("event_id"), F.xxhash64("id").alias("other"))
    write_sorted(rows.orderBy("other"), folder, "event_id", group_rows=1000)
    found = files.rows_for_event(spark, folder, event_id="31234", schema=rows.schema)
    assert [r.other for r in found.collect()] == [rows.where("event_id = 31234").first().other]
    assert scan_rows(found) <= 1000


def test_a_lookup_over_batches_reads_the_one_that_has_the_id(spark, folder):
    """Ids are random, so each batch spans the whole range of ids and only the Bloom filters tell them apart."""
    table = BatchTable(spark, folder).create()
    draw = random.Random(4)
    ids = [[str(uuid.UUID(int=draw.getrandbits(128))) for _ in range(2000)] for _ in range(8)]
    for batch, own in enumerate(ids):
        rows = spark.createDataFrame([(i,) for i in own], "event_id string").coalesce(1)
        names = ("event_type", "user_id", "username", "service", "usage_type", "timestamp")
        table.append(rows.select("event_id", *[F.lit("x").alias(n) for n in names], F.lit(1).alias("quantity")), batch)
    wanted = ids[5][77]
    found = table.rows().where(F.col("event_id") == wanted)
    assert [(r.event_id, r.batch_id) for r in found.collect()] == [(wanted, 5)]
    assert scan_rows(found) < 2 * 2000
    assert scan_rows(table.rows().where(F.col("event_id") == str(uuid.UUID(int=5)))) < 2000


def test_payloads_keep_their_types(spark):
    messages = [
        (1, {"event_id": "e", "stage": "s", "status": "a", "n": 1, "o": {"x": [1, None]}, "gone": "v", "kept": 2.5}),
        (2, {"event_id": "e", "stage": "s", "status": "b", "n": "1", "gone": None}),
        (3, {"event_id": "e", "stage": "s", "status": "", "n": True}),
        (4, {"event_id": 7, "stage": "s", "status": "c", "n": True}),
        (5, [1, 2]),
        (6, "text"),
    ]
    frame = spark.createDataFrame([(a, json.dumps(m)) for a, m in messages] + [(7, "{bad"), (8, None)], "arrival long, value string")
    typed = status.typed_status(frame)
    got = {(r.event_id, r.field): (r.field_json, r.field_type, r.arrival) for r in status.fold_payload(typed).collect()}
    assert got == {
        ("e", "status"): ('"b"', "STRING", 2),
        ("e", "n"): ('"1"', "STRING", 2),
        ("e", "o"): ('{"x":[1,null]}', "OBJECT<x: ARRAY<BIGINT>>", 1),
        ("e", "gone"): ("null", "VOID", 2),
        ("e", "kept"): ("2.5", "DECIMAL(2,1)", 1),
        ("7", "status"): ('"c"', "STRING", 4),
        ("7", "n"): ("true", "BOOLEAN", 4),
    }
    assert status.invalid_status(typed.drop("payload")).count() == 5
    number = status.fold_payload(typed).where("event_id = 'e' AND field = 'kept'").select(F.try_variant_get("field_value", "$", "double").alias("x"))
    assert number.first().x == 2.5
    plan = status.fold_payload(typed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("ParseJson") <= 1
