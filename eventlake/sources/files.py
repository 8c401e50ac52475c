"""Parquet files as files: lookups and previews that tell which file a row came from.

These look at physical files. A table format may still hold files whose rows were deleted from the
table, so nothing here says what the table contains now.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.text import clamp

# Row limits of the lookups are clamped, not refused.
MAX_ROWS = 1000
LOOKUP_DEFAULT = 100
PREVIEW_DEFAULT = 50

_LISTING = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])


def data_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the Parquet files directly in ``folder``; empty when it does not exist.

    File contents are never read: only the two listing columns are asked for.
    """
    try:
        return _listing(spark, [folder], recursive=False)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _LISTING)
        raise


def _listing(spark: SparkSession, paths: list[str], recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return reader.option("recursiveFileLookup", recursive).load(paths).select("path", "length")


def rows_with_file(
    spark: SparkSession, *paths: str, schema: T.StructType | None = None, skip_bad: bool = False
) -> DataFrame:
    """All rows below the paths with ``_parquet_file`` and ``_row`` (row number inside the file).

    A file that cannot be read fails the query, unless ``skip_bad`` asks to leave it out; then say
    so beside the rows with ``unread_files``.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    reader = reader.option("ignoreCorruptFiles", skip_bad)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*paths)
    return df.select(
        "*", F.col("_metadata.file_path").alias("_parquet_file"), F.col("_metadata.row_index").alias("_row")
    )


def equals_text(df: DataFrame, column: str, text: str):
    """``column`` printed as text equals ``text``, in a form the Parquet scan can push down."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return F.col(column) == text
    if isinstance(dtype, T.IntegralType):
        digits = text[1:] if text.startswith("-") else text
        if digits.isascii() and digits.isdigit() and str(int(text)) == text:
            return F.col(column) == F.lit(int(text))
        return F.lit(False)
    return F.col(column).cast("string") == text


def rows_for_event(
    spark: SparkSession,
    *paths: str,
    event_id: object,
    limit: int = LOOKUP_DEFAULT,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows of one event id with their file, in file and row order."""
    df = rows_with_file(spark, *paths, schema=schema)
    found = df.where(equals_text(df, "event_id", str(event_id)))
    return found.orderBy("_parquet_file", "_row").limit(clamp(limit, 1, MAX_ROWS))


def first_rows(
    spark: SparkSession, *paths: str, limit: int = PREVIEW_DEFAULT, schema: T.StructType | None = None
) -> DataFrame:
    """The first rows in file and row order.

    The rows are chosen by their file and number alone, for which no column is read; the chosen
    ones, at most ``MAX_ROWS``, are then taken from the files.
    """
    rows = rows_with_file(spark, *paths, schema=schema)
    place = ["_parquet_file", "_row"]
    chosen = rows.select(*place).orderBy(*place).limit(clamp(limit, 1, MAX_ROWS))
    return rows.join(F.broadcast(chosen), place, "left_semi").select(*rows.columns).orderBy(*place)


def lookup_report(
    spark: SparkSession, *paths: str, event_id: object, limit: int = LOOKUP_DEFAULT, schema: T.StructType | None = None
) -> DataFrame:
    """What a lookup says beside its rows: rows returned, files looked through, their names in order."""
    found = rows_for_event(spark, *paths, event_id=event_id, limit=limit, schema=schema)
    names = _listing(spark, list(paths), recursive=True).agg(F.sort_array(F.collect_set(file_name(F.col("path")))).alias("files"))
    rows = found.agg(F.count(F.lit(1))).scalar()
    return names.select(F.lit(str(event_id)).alias("event_id"), rows.alias("row_count"), F.size("files").alias("files_scanned"), "files")


def unread_files(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Paths of the files that gave no row to a reader that skips bad files: unreadable or empty ones."""
    listed = _listing(spark, list(paths), recursive=True).select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    rows = rows_with_file(spark, *paths, schema=schema, skip_bad=True)
    read = rows.select(F.regexp_replace("_parquet_file", "^file:/+", "/").alias("path")).distinct()
    return listed.join(read, "path", "left_anti")


def file_row_counts(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows per data file."""
    return rows_with_file(spark, *paths).groupBy("_parquet_file").agg(F.count(F.lit(1)).alias("row_count"))


def file_name(path):
    return F.element_at(F.split(path, "/"), -1)
