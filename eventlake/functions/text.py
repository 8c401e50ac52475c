"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only removes blanks)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def words(c: Column) -> Column:
    """Whitespace-separated words of the stripped text."""
    return F.split(strip(c), r"(?U)\s+")


def first_word(c: Column) -> Column:
    return F.try_element_at(words(c), F.lit(1))


def last_word(c: Column) -> Column:
    return F.try_element_at(words(c), F.lit(-1))


def is_blank(c: Column) -> Column:
    """True for null, empty, or all-whitespace text."""
    return F.coalesce(F.length(strip(c)), F.lit(0)) == 0


def is_empty(c: Column) -> Column:
    """True for null or empty text; whitespace counts as content."""
    return F.coalesce(F.length(c), F.lit(0)) == 0


def contains_ignore_case(c: Column, needle: str) -> Column:
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def preview(c: Column, length: int = 20) -> Column:
    """The text itself when short enough, else its first ``length`` characters and an ellipsis."""
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit("…"))).otherwise(c)


def head_preview(c: Column, length: int = 12) -> Column:
    """First ``length`` characters, always followed by an ellipsis."""
    return F.concat(F.substring(c, 1, length), F.lit("…"))


def bytes_to_text(c: Column) -> Column:
    """UTF-8 text of a binary column; bad byte sequences become the replacement character."""
    return F.make_valid_utf8(c.cast("string"))


def first_value(values: Column) -> Column:
    """First entry of an attribute list as text, or ``''`` when there is none."""
    return F.coalesce(F.try_element_at(values, F.lit(1)).cast("string"), F.lit(""))


def clamp(value: int, low: int, high: int) -> int:
    return max(low, min(value, high))
