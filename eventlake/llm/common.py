"""Helpers shared by the text operators: column set-up, bounded Arrow slices, held-out folds."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text bytes that one vectorised step inside a task works on; a longer single text is a step of its own.
SLICE_BYTES = 4 * 1024**2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), under the names the operators use; other columns cannot clash."""
    return df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.fromiter((0 if n is None else n for n in pc.binary_length(col).to_pylist()), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a slice end to end, and the offsets of the texts (one more than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    return flat, offsets - offsets[0]


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame written once to the shared checkpoint folder and read from there.

    The folder is the session's ``spark.checkpoint.dir``; only a local session without one gets a folder of its own.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared checkpoint folder; for many small rows, which it packs better."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/frame-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from ``spark.checkpoint.dir`` if it is not yet."""
    if not spark.sparkContext.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            shared = tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(shared)
    return spark.sparkContext.getCheckpointDir()


def sampled(labelled: DataFrame, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each value, 0 or 1, of ``label``, all of a rarer one.

    Rows are taken by a hash of their ``doc_id``, at a rate set by the size of the class, so no class is gathered in
    one place. Other labels are left out. The driver learns only the counts.
    """
    counts = labelled.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    kept = F.lit(False)
    for value, count in counts:
        kept = kept | ((F.col(label) == F.lit(value)) & (share < min(1.0, per_class / count)))
    return labelled.where(kept)
