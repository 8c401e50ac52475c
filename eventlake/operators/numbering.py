"""Rows dealt to ordered blocks of equal depth, and dense numbers over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.session import work_folder

# A place is the number of a block, then the row's number inside it; the low bits hold the latter.
BLOCK_BITS = 33


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written once to a fresh shared folder and read from there.

    What follows can use it several times, and a lost executor costs no more than reading it again. As the size of
    the files is known, Spark itself decides whether it is small enough to be broadcast.
    """
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def in_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int | None = None, settle: bool = True
) -> DataFrame:
    """The rows with ``_at``, a number that grows with (keys, order); ``block_of_place`` tells the block.

    Spark deals the rows into ranges of about equal depth, whose bounds it finds from a sample of the rows themselves:
    a stray value or a key with half of all rows does not make a long block. The rows are written, so that all later
    uses see the same blocks. ``settle`` writes them before as well; without it the sample computes them a second time,
    which suits rows that cost little.
    """
    by = [*keys, *order]
    if settle:
        df = written(df, "rows")
    dealt = df.repartitionByRange(blocks, *by) if blocks else df.repartitionByRange(*by)
    return written(dealt.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "blocks")


def block_of_place(at: Column | str = "_at") -> Column:
    return F.shiftright(at, BLOCK_BITS)


def block_starts(df: DataFrame, keys: Sequence[str], block: str, rows: Column, *extra: tuple[Column, str]) -> DataFrame:
    """Per (keys, block): what earlier blocks of the same keys hold, ``rows_before`` as the sum of ``rows``.

    ``extra`` are (aggregate column, name) pairs for which the maximum over earlier blocks is kept.
    The window runs over block summaries: one row per block, not per input row.
    """
    sizes = df.groupBy(*keys, block).agg(rows.alias("_n"), *[agg.alias(name) for agg, name in extra])
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *keys,
        block,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("rows_before"),
        *[F.max(name).over(before).alias(name) for _, name in extra],
    )


def dense_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "offset", first: DataFrame | None = None, blocks: int | None = None
) -> DataFrame:
    """Rows numbered 0, 1, 2, ... per ``keys`` in the order of ``order`` (nulls first, equal rows in any order).

    Two-level prefix sum: rows of a key lie side by side inside a block, so a row's number is its distance from the
    key's first row there plus the rows that the key has in earlier blocks. Only a row per key and block is gathered by
    key, and no task holds a key. ``first`` gives (keys, ``name``) to go on from; a key it does not have starts at 0.
    """
    placed = in_blocks(df, keys, order, blocks)
    block = block_of_place()
    sizes = placed.groupBy(*keys, block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
    if first is not None:
        given = first.select(*[F.col(k).alias(f"_given_{k}") for k in keys], F.col(name).alias("_given"))
        same = [F.col(k).eqNullSafe(F.col(f"_given_{k}")) for k in keys]
        starts = starts.join(given, same, "left").withColumn("_base", F.col("_base") + F.coalesce("_given", F.lit(0)))
    starts = written(starts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_block", "_base"), "starts")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    numbered = placed.join(starts, [block == F.col("_block"), *same])
    return numbered.select(*df.columns, (F.col("_at") + F.col("_base")).alias(name))
