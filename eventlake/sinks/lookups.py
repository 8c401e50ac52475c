"""Parquet files made for lookups by one id."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter

# Rows and bytes of a row group: what a lookup has to read of a file that may hold the id.
GROUP_ROWS = 100_000
GROUP_BYTES = 16 * 1024**2


def lookup_writer(writer: DataFrameWriter, key: str, group_rows: int = GROUP_ROWS) -> DataFrameWriter:
    """A Parquet writer that adds a Bloom filter of ``key`` to each row group and keeps the groups small.

    An equality filter then skips the groups whose range or Bloom filter excludes the value.
    """
    return (
        writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(group_rows))
        .option("parquet.block.size", str(GROUP_BYTES))
        .option("parquet.block.row.count.limit", str(group_rows))
    )


def write_sorted(df: DataFrame, folder: str, key: str, mode: str = "append", group_rows: int = GROUP_ROWS) -> None:
    """Write rows in ranges of ``key``: a value is in one file, and files and row groups have ranges that do not overlap."""
    dealt = df.repartitionByRange(key).sortWithinPartitions(key)
    lookup_writer(dealt.write.mode(mode), key, group_rows).parquet(folder)
