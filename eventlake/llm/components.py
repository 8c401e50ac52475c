"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed


def contracted(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b: neighbours are tied to the least one around them."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.join(least, "u")
    if large:
        tied = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        tied = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return tied.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of every node of the edges (a, b); isolated nodes have no row.

    Every round is written to the checkpoint folder, so a lost executor costs one round. Rounds end when the edges
    no longer change, which takes about the logarithm of the longest path.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    state = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
        if mark == state or not mark[0]:
            break
        state = mark
        now = checkpointed(contracted(contracted(now, True), False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
