"""Usage totals and cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: price of one unit of any service.
UNIT_PRICE = 100


def usage_rollup(events: DataFrame) -> DataFrame:
    """Events and total quantity per user, service and usage type."""
    return events.groupBy("user_id", "service", "usage_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("quantity").cast("long")).alias("total_quantity")
    )


def with_cost(events: DataFrame, unit_price: int = UNIT_PRICE) -> DataFrame:
    """Cost per event; a missing quantity costs nothing."""
    quantity = F.coalesce(F.col("quantity"), F.lit(0)).cast("long")
    return events.withColumn("cost", quantity * F.lit(unit_price))


def billing_cost(events: DataFrame, unit_price: int = UNIT_PRICE) -> DataFrame:
    """Cost per user and service."""
    return (
        with_cost(events, unit_price)
        .groupBy("user_id", "service")
        .agg(F.sum(F.coalesce("quantity", F.lit(0)).cast("long")).alias("quantity"), F.sum("cost").alias("cost"))
    )
