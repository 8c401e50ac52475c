import datetime

import pytest
from pyspark.sql import functions as F

from eventlake.operators import history
from eventlake.operators.ingest import parse_events
from eventlake.schemas import COMMIT_SCHEMA
from eventlake.sinks.batches import BatchTable
from eventlake.sources import files

START = datetime.datetime(2024, 1, 1)


def batch(spark, *ids):
    return parse_events(spark.createDataFrame([(f'{{"event_id":"{i}","quantity":1}}',) for i in ids], "value string"))


def ids(df):
    return sorted(r.event_id for r in df.collect())


def log(spark, *operations):
    """A commit log with the given operations, numbered from 1."""
    rows = [(n, n, n - 1 or None, START + datetime.timedelta(hours=n), op, {"n": str(n)}, None) for n, op in enumerate(operations, start=1)]
    return spark.createDataFrame(rows, COMMIT_SCHEMA)


def table(spark, **added):
    """Rows with the commit that appended them, as c1="ab"."""
    frames = [batch(spark, *names).withColumn("commit_seq", F.lit(int(seq[1:])).cast("long")) for seq, names in added.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def test_history_survives_a_clear(spark):
    commits = log(spark, "append", "append", "delete", "append")
    rows = table(spark, c1="ab", c2="c", c4="d")
    with pytest.raises(ValueError):
        history.check_confirmation("delete all rows")
    report = history.clear_effect(rows, commits, 3).first()
    assert (report.before_count, report.deleted_count, report.after_count) == (3, 3, 0)
    assert report.operation == "delete" and report.history_preserved and report.committed_at == START + datetime.timedelta(hours=3)
    assert ids(history.rows_at(rows, commits)) == ["d"]
    assert ids(history.rows_at(rows, commits, 1)) == ["a", "b"] and ids(history.rows_at(rows, commits, "2")) == ["a", "b", "c"]
    assert ids(history.rows_at(rows, commits, report.snapshot_id)) == []

    listed = history.snapshot_list(commits).collect()
    assert [r.snapshot_id for r in listed] == ["4", "3", "2", "1"]
    assert [r.parent_id for r in listed] == ["3", "2", "1", None]
    assert [r.is_current for r in listed] == [True, False, False, False]
    assert [r.is_current for r in history.snapshot_list(commits, F.lit(2), limit=3).collect()] == [False, False, True]
    assert tuple(history.snapshot_totals(commits).first()) == (4, 3, "4")
    assert tuple(history.snapshot_totals(commits, F.lit(2)).first()) == (4, 3, "2")
    assert tuple(history.snapshot_compare(rows, commits, 2).first()) == ("2", 3, 1)
    assert tuple(history.time_travel_summary(rows, commits, 2, 2).first()) == ("2", 3, 1, 2, 2)
    diff = sorted((r.change, r.event_id) for r in history.snapshot_diff(rows, commits, 2, 4).collect())
    assert diff == [("added", "d"), ("removed", "a"), ("removed", "b"), ("removed", "c")]
    assert history.table_count(rows, commits).first().total == 1
    assert history.latest_snapshot(commits).first().snapshot_id == 4


def test_totals_count_the_whole_log(spark):
    commits = log(spark, *["append"] * 130)
    assert history.snapshot_list(commits).count() == 100
    assert tuple(history.snapshot_totals(commits).first()) == (130, 129, "130")


def test_arguments_are_checked(spark):
    rows, commits = table(spark, c1="a"), log(spark, "append", "append")
    for bad in (0, 201, -1):
        with pytest.raises(ValueError):
            history.time_travel_rows(rows, commits, 1, bad)
    for bad in ("x", None, "1.5", "1_0", " 7 ", "", True):
        with pytest.raises(ValueError):
            history.time_travel_rows(rows, commits, bad)
    with pytest.raises(LookupError):
        history.time_travel_rows(rows, commits, 99)
    with pytest.raises(ValueError):
        history.clear_effect(rows, commits, 2)
    assert history.time_travel_rows(rows, commits, "1", 200).count() == 1
    assert history.rows_at(rows, commits.where("false")).isEmpty()


def test_batches_run_again(spark, folder):
    target = BatchTable(spark, folder).create()
    for replace, want in ((True, ["a"]), (False, ["a", "a"])):
        batch_id = 5 if replace else 6
        target.append(batch(spark, "a"), batch_id, replace)
        target.append(batch(spark, "a"), batch_id, replace)
        assert ids(target.rows().where(F.col("batch_id") == batch_id)) == want
    assert ids(BatchTable(spark, folder).create().current()) == ["a", "a", "a"]


def test_reads_prune_to_the_batches_they_need(spark, folder):
    target = BatchTable(spark, folder).create()
    for n in range(3):
        target.append(batch(spark, f"e{n}"), n)
    visible = target.rows().where("batch_id = 1")
    assert "(batch_id" in visible._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1][:120]
    assert ids(visible) == ["e1"]


def write(df, folder, name, n):
    df.coalesce(n).write.parquet(f"{folder}/{name}")


def test_file_lookups(spark, folder):
    for part, (low, high) in enumerate([(0, 3), (3, 4), (4, 40)]):
        write(spark.range(low, high).selectExpr("CAST(id % 7 AS string) AS event_id", "id"), folder, f"data/part={part}", 1)
    path = f"{folder}/data"
    found = files.rows_for_event(spark, path, event_id=3).collect()
    assert [r.id for r in found] == [3, 10, 17, 24, 31, 38]
    assert all(r._parquet_file.endswith(".parquet") for r in found) and [r._row for r in found][0] == 0
    assert files.rows_for_event(spark, path, event_id="3", limit=-9).count() == 1
    assert [r.id for r in files.first_rows(spark, path, limit=6).collect()] == [0, 1, 2, 3, 4, 5]
    assert files.first_rows(spark, path, limit=5000).count() == 40
    report = files.lookup_report(spark, path, event_id=3).first()
    assert (report.row_count, report.files_scanned) == (6, 3) and report.files == sorted(report.files)
    counts = files.file_row_counts(spark, path).collect()
    assert sorted(r.row_count for r in counts) == [1, 3, 36]
    assert files.data_files(spark, f"{path}/part=0").count() == 1
    assert files.data_files(spark, f"{folder}/missing").collect() == []


def test_lookup_pushes_its_filter_to_the_scan(spark, folder):
    write(spark.range(10).selectExpr("id AS event_id"), folder, "numbers", 1)
    plan = files.rows_for_event(spark, f"{folder}/numbers", event_id="7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_id,7)" in plan
    for text, n in {"7": 1, "07": 0, " 7": 0, "x": 0, "-7": 0}.items():
        assert files.rows_for_event(spark, f"{folder}/numbers", event_id=text).count() == n


def test_a_bad_file_fails_the_lookup_unless_it_is_left_out(spark, folder):
    write(spark.range(10).selectExpr("id AS event_id"), folder, "numbers", 1)
    with open(f"{folder}/numbers/part-bad.parquet", "wb") as bad:
        bad.write(b"not a parquet file")
    with pytest.raises(Exception):
        files.rows_with_file(spark, f"{folder}/numbers", schema="event_id long").collect()
    rows = files.rows_with_file(spark, f"{folder}/numbers", schema="event_id long", skip_bad=True)
    assert rows.count() == 10
    refused = files.unread_files(spark, f"{folder}/numbers", schema="event_id long").collect()
    assert [r.path.rsplit("/", 1)[1] for r in refused] == ["part-bad.parquet"]
