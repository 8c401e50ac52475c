"""CASE expressions from lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(cases: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """Value of the first condition that holds, else ``otherwise``."""
    (condition, value), *rest = cases
    column = F.when(condition, value)
    for condition, value in rest:
        column = column.when(condition, value)
    return column.otherwise(otherwise)
