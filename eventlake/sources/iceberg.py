"""Snapshot queries on a real Iceberg table. They need the Iceberg runtime and a configured catalog.

The statements are plain Spark SQL; ids go through ``check_snapshot_id`` before they enter the text.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.history import (
    DELETE,
    SNAPSHOT_LIST_LIMIT,
    TIME_TRAVEL_DEFAULT,
    check_confirmation,
    check_limit,
    check_snapshot_id,
)
from eventlake.functions.json_safe import id_text
from eventlake.schemas import EVENT_COLUMNS, create_namespace_ddl, create_table_ddl


def ensure_table(spark: SparkSession, table: str) -> None:
    spark.sql(create_namespace_ddl(table))
    spark.sql(create_table_ddl(table))


def append(df: DataFrame, table: str) -> None:
    df.select(*EVENT_COLUMNS).writeTo(table).append()


def snapshots(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(f"{table}.snapshots")


def current_snapshot_id(spark: SparkSession, table: str) -> int | None:
    """Head of the main branch; the newest snapshot where the table has no refs to read. Other faults are raised."""
    try:
        head = spark.table(f"{table}.refs").where(F.col("name") == "main").select("snapshot_id").first()
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        head = None
    return head[0] if head else newest_snapshot_id(spark, table)


def newest_snapshot_id(spark: SparkSession, table: str) -> int | None:
    newest = snapshots(spark, table).orderBy(F.desc("committed_at")).select("snapshot_id").first()
    return newest[0] if newest else None


def data_file_count(spark: SparkSession, table: str) -> int:
    """Data files of the current table state, as the newest snapshot's summary states them."""
    newest = snapshots(spark, table).orderBy(F.desc("committed_at")).select("summary").first()
    return int(newest[0].get("total-data-files", 0)) if newest else 0


def snapshot_list(spark: SparkSession, table: str, limit: int = SNAPSHOT_LIST_LIMIT) -> DataFrame:
    """Newest snapshots first, ids as text, the current one marked."""
    newest = snapshots(spark, table).orderBy(F.desc("committed_at")).limit(limit)
    current: Column = F.lit(current_snapshot_id(spark, table)).cast("long")
    return newest.select(
        "committed_at",
        id_text(F.col("snapshot_id")).alias("snapshot_id"),
        id_text(F.col("parent_id")).alias("parent_id"),
        "operation",
        "summary",
        F.coalesce(F.col("snapshot_id") == current, F.lit(False)).alias("is_current"),
    )


def rows_at(spark: SparkSession, table: str, snapshot_id: int | str) -> DataFrame:
    wanted = check_snapshot_id(snapshot_id)
    if snapshots(spark, table).where(F.col("snapshot_id") == wanted).limit(1).isEmpty():
        raise LookupError(f"snapshot not found: {wanted}")
    return spark.sql(f"SELECT * FROM {table} VERSION AS OF {wanted}")


def time_travel(
    spark: SparkSession, table: str, snapshot_id: int | str, limit: int = TIME_TRAVEL_DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(rows at the snapshot, one row of counts)."""
    check_limit(limit)
    then = rows_at(spark, table, snapshot_id)
    rows = then.orderBy(*then.columns).limit(limit)
    now_count = spark.table(table).agg(F.count(F.lit(1))).scalar()
    counts = then.agg(F.count(F.lit(1)).alias("historical_count")).select(
        F.lit(str(check_snapshot_id(snapshot_id))).alias("snapshot_id"),
        "historical_count",
        now_count.alias("current_count"),
        F.least(F.col("historical_count"), F.lit(limit).cast("long")).alias("returned_rows"),
        F.lit(limit).alias("limit"),
    )
    return rows, counts


def clear(spark: SparkSession, table: str, confirmation: str) -> dict:
    """Delete all rows, keep the history, report what happened."""
    check_confirmation(confirmation)
    before = spark.table(table).count()
    spark.sql(f"DELETE FROM {table}")
    after = spark.table(table).count()
    newest = snapshots(spark, table).orderBy(F.desc("committed_at")).select("snapshot_id", "committed_at").first()
    return {
        "before_count": before,
        "deleted_count": before - after,
        "after_count": after,
        "snapshot_id": None if newest is None else str(newest.snapshot_id),
        "committed_at": None if newest is None else newest.committed_at,
        "operation": DELETE,
        "history_preserved": True,
    }
