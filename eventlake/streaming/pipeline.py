"""The ingest pipeline: micro-batches of usage events into a table, with stage status records."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.ingest import batch_event_ids, status_records
from eventlake.sinks.batches import BatchTable, Written
from eventlake.sinks.topics import Publisher, best_effort
from eventlake.sources import iceberg
from eventlake.streaming.readers import BatchHandler

_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Target:
    """Where a batch goes.

    ``append`` returns the snapshot id, or None when it cannot be told. ``count_files`` takes that
    id and tells how many data files are there.
    """

    table: str
    bucket: str
    path: str
    append: Callable[[DataFrame, int], str | None]
    count_files: Callable[[str | None], int]


def parquet_target(
    table: BatchTable, bucket: str = "", replace: bool = True, receipt: Callable[[Written], None] | None = None
) -> Target:
    """A batch is its own snapshot. Its files are counted by the job that writes them, so nothing is listed
    or counted afterwards; ``receipt`` is called with the figures of each batch that has been written."""
    files: dict[str | None, int] = {}

    def append(df: DataFrame, batch_id: int) -> str:
        written = table.append_counted(df, batch_id, replace)
        files[str(batch_id)] = written.files
        if receipt:
            receipt(written)
        return str(batch_id)

    return Target(table.folder, bucket, table.folder, append, lambda snapshot_id: files.pop(snapshot_id))


def iceberg_target(spark: SparkSession, table: str, bucket: str, path: str) -> Target:
    """Needs the Iceberg runtime. The file count is the one the newest snapshot's summary states,
    so that no batch lists the table's files."""

    def append(df: DataFrame, batch_id: int) -> str | None:
        iceberg.append(df, table)
        try:
            newest = iceberg.newest_snapshot_id(spark, table)
        except Exception as error:  # the write has been committed; the id is only information
            _log.warning("snapshot lookup failed: %s", error)
            return None
        return None if newest is None else str(newest)

    return Target(table, bucket, path, append, lambda snapshot_id: iceberg.data_file_count(spark, table))


def batch_handler(target: Target, publish: Publisher) -> BatchHandler:
    """Append each batch and report every stage for each of its event ids.

    The batch is read from the source once and kept for all its uses. Event ids stay a distributed
    frame. Status records are best effort; a failed append or a missing file fails the batch, and the
    target decides whether a batch that failed after its append counts twice on retry.
    """
    announce = best_effort(publish)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        ids = batch_event_ids(batch).persist()
        tag = {"batch_id": F.lit(batch_id).cast("long")}

        def report(stage: str, status: str, **extras: Column) -> None:
            announce(status_records(ids, [(stage, status, {**tag, **extras})]).select("key", "value"))

        try:
            if ids.isEmpty():
                _log.info("batch %s has no event ids", batch_id)
                return
            report("spark", "completed")
            report("iceberg", "processing")
            try:
                snapshot_id = target.append(batch, batch_id)
            except Exception as error:
                report("iceberg", "failed", error=F.lit(str(error)))
                report("spark", "failed", error=F.lit(str(error)))
                raise
            report(
                "iceberg",
                "completed",
                table=F.lit(target.table),
                snapshot_id=F.lit(snapshot_id).cast("string"),
            )
            report("minio", "processing")
            files = target.count_files(snapshot_id)
            if files == 0:
                message = f"no Parquet files at {target.path}"
                report("minio", "failed", error=F.lit(message), path=F.lit(target.path))
                raise RuntimeError(message)
            report(
                "minio",
                "completed",
                bucket=F.lit(target.bucket),
                path=F.lit(target.path),
                parquet_files=F.lit(files),
            )
        finally:
            ids.unpersist()
            batch.unpersist()

    return handle
