"""Snapshots, time travel and clear accounting over a table with a commit log.

``commits`` has one row per commit (``seq`` grows with every commit). Table rows carry the
``commit_seq`` that appended them. A clear removes every row, so it is only a commit: a row is
visible at a snapshot when it was appended after the last clear up to there. Time travel is thus a
range filter on ``commit_seq``; clearing never rewrites data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.json_safe import id_text
from eventlake.schemas import EVENT_COLUMNS

# Commit kinds, the text that confirms a clear, and the list and row limits.
APPEND = "append"
DELETE = "delete"
CLEAR_CONFIRMATION = "DELETE ALL ROWS"
SNAPSHOT_LIST_LIMIT = 100
TIME_TRAVEL_LIMIT = 200
TIME_TRAVEL_DEFAULT = 100


def check_confirmation(text: str) -> None:
    if text != CLEAR_CONFIRMATION:
        raise ValueError(f'confirmation must be exactly "{CLEAR_CONFIRMATION}"')


def check_snapshot_id(snapshot_id: int | str) -> int:
    """The id as a number: digits with an optional minus sign, nothing else."""
    text = str(snapshot_id)
    if isinstance(snapshot_id, bool) or not re.fullmatch(r"-?[0-9]+", text, re.ASCII):
        raise ValueError(f"not a snapshot id: {text!r}")
    return int(text)


def check_limit(limit: int, most: int = TIME_TRAVEL_LIMIT) -> int:
    if limit not in range(1, most + 1):
        raise ValueError(f"between 1 and {most} rows can be asked for, not {limit}")
    return limit


def head_id(commits: DataFrame) -> Column:
    """Id of the newest snapshot as a scalar subquery."""
    return commits.agg(F.max_by("snapshot_id", "seq")).scalar()


def latest_snapshot(commits: DataFrame) -> DataFrame:
    return commits.orderBy(F.desc("seq")).limit(1)


def snapshot_list(commits: DataFrame, current_id: Column | None = None, limit: int = SNAPSHOT_LIST_LIMIT) -> DataFrame:
    """Newest snapshots first, ids as text, the current one marked.

    ``current_id`` is the head of the branch; after a rollback it is not the newest snapshot.
    """
    current = head_id(commits) if current_id is None else current_id
    newest = commits.orderBy(F.desc("committed_at"), F.desc("seq")).limit(limit)
    return newest.select(
        "committed_at",
        id_text(F.col("snapshot_id")).alias("snapshot_id"),
        id_text(F.col("parent_id")).alias("parent_id"),
        "operation",
        "summary",
        (F.col("snapshot_id") == current).alias("is_current"),
    )


def snapshot_totals(commits: DataFrame, current_id: Column | None = None) -> DataFrame:
    """Snapshots of the whole log, those that are not current, and the current one's id."""
    current = head_id(commits) if current_id is None else current_id
    totals = commits.agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count_if(~F.col("snapshot_id").eqNullSafe(current)).alias("historical"),
    )
    return totals.withColumn("current_snapshot_id", id_text(current))


@dataclass(frozen=True)
class Bounds:
    """Commit numbers whose rows are visible: above ``cleared``, up to ``last``."""

    cleared: int
    last: int

    def holds(self) -> Column:
        return (F.col("commit_seq") > self.cleared) & (F.col("commit_seq") <= self.last)


def snapshot_bounds(commits: DataFrame, snapshot_id: int | str | None = None) -> Bounds:
    """Bounds of a snapshot, or of the newest one; a snapshot that does not exist is refused.

    Two numbers are looked up in the commit log now, so that the table scan gets a literal range:
    it prunes files and folders when it is planned.
    """
    upto = commits
    if snapshot_id is not None:
        wanted = check_snapshot_id(snapshot_id)
        own = commits.where(F.col("snapshot_id") == wanted).agg(F.max("seq")).scalar()
        upto = commits.where(F.col("seq") <= own)
    cleared = F.max(F.when(F.col("operation") == DELETE, F.col("seq")))
    found = upto.agg(F.max("seq").alias("last"), cleared.alias("cleared")).first()
    if found["last"] is None:
        if snapshot_id is not None:
            raise LookupError(f"snapshot not found: {wanted}")
        return Bounds(-1, -1)
    return Bounds(-1 if found["cleared"] is None else found["cleared"], found["last"])


def rows_at(rows: DataFrame, commits: DataFrame, snapshot_id: int | str | None = None) -> DataFrame:
    """Rows visible at a snapshot, or now."""
    return rows.where(snapshot_bounds(commits, snapshot_id).holds())


def table_count(rows: DataFrame, commits: DataFrame) -> DataFrame:
    return rows_at(rows, commits).agg(F.count(F.lit(1)).alias("total"))


def time_travel_rows(
    rows: DataFrame, commits: DataFrame, snapshot_id: int | str, limit: int = TIME_TRAVEL_DEFAULT
) -> DataFrame:
    """Up to ``limit`` rows at a snapshot in event-id order; bad arguments are refused."""
    check_limit(limit)
    visible = rows_at(rows, commits, check_snapshot_id(snapshot_id)).select(*EVENT_COLUMNS)
    return visible.orderBy(*EVENT_COLUMNS).limit(limit)


def snapshot_compare(rows: DataFrame, commits: DataFrame, snapshot_id: int | str) -> DataFrame:
    """Row counts at a snapshot and now, from one pass over the table."""
    wanted = check_snapshot_id(snapshot_id)
    then, now = snapshot_bounds(commits, wanted), snapshot_bounds(commits)
    return (
        rows.where(then.holds() | now.holds())
        .agg(
            F.count_if(then.holds()).alias("historical_count"),
            F.count_if(now.holds()).alias("current_count"),
        )
        .select(F.lit(str(wanted)).alias("snapshot_id"), "historical_count", "current_count")
    )


def time_travel_summary(
    rows: DataFrame, commits: DataFrame, snapshot_id: int | str, limit: int = TIME_TRAVEL_DEFAULT
) -> DataFrame:
    """What a time-travel call reports beside its rows."""
    check_limit(limit)
    return (
        snapshot_compare(rows, commits, snapshot_id)
        .withColumn("returned_rows", F.least(F.col("historical_count"), F.lit(limit).cast("long")))
        .withColumn("limit", F.lit(limit))
    )


def snapshot_diff(
    rows: DataFrame, commits: DataFrame, from_id: int | str, to_id: int | str
) -> DataFrame:
    """Rows visible at only one of two snapshots, with the side in ``change``."""
    before = snapshot_bounds(commits, check_snapshot_id(from_id)).holds()
    after = snapshot_bounds(commits, check_snapshot_id(to_id)).holds()
    change = F.when(before, "removed").otherwise("added")
    return rows.where((before & ~after) | (after & ~before)).select(change.alias("change"), *EVENT_COLUMNS)


def append_effect(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """Rows each append commit brought, and how many distinct events they hold."""
    sizes = rows.groupBy("commit_seq", "event_id").agg(F.count(F.lit(1)).alias("n"))
    per_commit = sizes.groupBy("commit_seq").agg(
        F.sum("n").alias("appended_rows"), F.count("event_id").alias("event_ids")
    )
    return (
        commits.where(F.col("operation") == APPEND)
        .join(per_commit, F.col("seq") == F.col("commit_seq"), "left")
        .select(
            id_text(F.col("snapshot_id")).alias("snapshot_id"),
            "operation",
            F.coalesce("appended_rows", F.lit(0)).alias("appended_rows"),
            F.coalesce("event_ids", F.lit(0)).alias("event_ids"),
        )
    )


def clear_effect(rows: DataFrame, commits: DataFrame, snapshot_id: int | str) -> DataFrame:
    """Report of a clear: rows before, deleted and after, from one pass over the rows it concerns."""
    wanted = check_snapshot_id(snapshot_id)
    after = snapshot_bounds(commits, wanted)
    if after.cleared != after.last:
        raise ValueError(f"snapshot is not a clear: {wanted}")
    before = snapshot_bounds(commits.where(F.col("seq") < after.last))
    committed_at = commits.where(F.col("seq") == after.last).agg(F.max("committed_at")).scalar()
    counted = rows.where(before.holds() | after.holds()).agg(
        F.count_if(before.holds()).alias("before_count"), F.count_if(after.holds()).alias("after_count")
    )
    return counted.select(
        "before_count",
        (F.col("before_count") - F.col("after_count")).alias("deleted_count"),
        "after_count",
        F.lit(str(wanted)).alias("snapshot_id"),
        committed_at.alias("committed_at"),
        F.lit(DELETE).alias("operation"),
        F.lit(True).alias("history_preserved"),
    )


def reset_effect(cleared: DataFrame, retained: DataFrame) -> DataFrame:
    """Clear report plus the events dropped from the status state; logs and history stay."""
    dropped = retained.agg(F.count(F.lit(1))).scalar()
    return cleared.withColumn("cleared_pipeline_events", dropped).withColumn(
        "messages_preserved", F.lit(True)
    )
