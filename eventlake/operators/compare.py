"""Two versions of a table compared as multisets of rows, without commit numbers on the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.numbering import written

# Buckets of a comparison by hash, and differing buckets that are put into the second scan as literals.
BUCKETS = 1024
MOST_LITERALS = 10_000


def _digests(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit digests of a row, in halves that can be summed up. Null flags are hashed too, since a hash of
    several columns passes over nulls."""
    nulls = [F.col(c).isNull() for c in columns]
    halves = []
    for seed in (0, 1):
        digest = F.xxhash64(F.lit(seed), *columns, *nulls)
        halves += [digest.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(digest, 32)]
    return halves


def bucket_sums(df: DataFrame, columns: Sequence[str], bucket: Column) -> DataFrame:
    """Rows and digest sums per bucket: equal for equal multisets of rows, combined before the shuffle."""
    sums = [F.sum(d).alias(f"_s{i}") for i, d in enumerate(_digests(columns))]
    return df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"), *sums)


def differing_buckets(left: DataFrame, right: DataFrame, columns: Sequence[str], bucket: Column) -> DataFrame:
    """The buckets whose rows are not the same multiset in both tables."""
    one, other = (bucket_sums(df, columns, bucket) for df in (left, right))
    names = ["_rows", "_s0", "_s1", "_s2", "_s3"]
    both = one.unionByName(other.select("_bucket", *[(-F.col(c)).alias(c) for c in names]))
    net = both.groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in names])
    unequal = F.lit(False)
    for name in names:
        unequal = unequal | (F.col(name) != 0)
    return net.where(unequal).select("_bucket")


def table_diff(left: DataFrame, right: DataFrame, bucket: Column | str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows that only one of two tables has: ``change`` (removed, added), the columns, ``copies`` more than the other.

    The same as ``EXCEPT ALL`` both ways. Bucket sums of both tables are compared first; only rows of buckets that differ
    are read and grouped. Give a partition column as ``bucket`` and the second scan skips the folders of equal buckets;
    by default a row's bucket is its hash, which saves the shuffle of equal rows but not their scan. Two different
    buckets pass for equal if 128 bits of digest sums agree by chance. Both tables have the same columns.
    """
    columns = list(left.columns)
    if bucket is None:
        by = F.pmod(F.xxhash64(*columns), F.lit(buckets))
    else:
        by = F.col(bucket) if isinstance(bucket, str) else bucket
    differing = written(differing_buckets(left, right.select(*columns), columns, by), "differing-buckets")
    if differing.count() <= MOST_LITERALS:
        found = [row[0] for row in differing.collect()]
        chosen = by.isin([f for f in found if f is not None])
        if None in found:
            chosen = chosen | by.isNull()
        sides = [df.where(chosen) for df in (left, right)]
    else:
        sides = [df.join(differing, by.eqNullSafe(F.col("_bucket")), "left_semi") for df in (left, right)]
    one, other = (df.select(*columns, F.lit(sign).cast("bigint").alias("_n")) for df, sign in zip(sides, (1, -1)))
    net = one.unionByName(other).groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return net.select(F.when(F.col("_n") > 0, "removed").otherwise("added").alias("change"), *columns, F.abs("_n").alias("copies"))
