"""Event-time text and timestamps. All functions assume the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event-time text is UTC with microseconds and an explicit offset.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
# The usual shape: date, optional time with optional fraction and optional zone.
ISO_SHAPE = r"\A(?!0000)\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2}(:\d{2})?)?)?\z"
# Every shape: calendar or week date, extended or compact; any separator; time and offset, extended or compact.
_HOUR, _SIXTY, _PART = r"(?:[01]\d|2[0-3])", r"[0-5]\d", r"(?:[.,]\d+)?"
_DATE = r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?)"
_CLOCK = f"{_HOUR}(?::{_SIXTY}(?::{_SIXTY}{_PART})?|{_SIXTY}(?:{_SIXTY}{_PART})?)?"
ANY_SHAPE = rf"(?s)\A(?!0000){_DATE}(?:.({_CLOCK})(Z|[+-]{_CLOCK})?)?\z"


def event_time_text(ts: Column) -> Column:
    return F.date_format(ts, EVENT_TIME_FORMAT)


def now_text() -> Column:
    return event_time_text(F.current_timestamp())


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp; ``Z`` or no zone means UTC; anything else gives null.

    Calendar dates and week dates (a week alone is its Monday), extended or compact; digits beyond microseconds are
    cut off. Only texts that are not in the usual shape take the longer way.
    """
    usual = F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text))
    return F.coalesce(usual, F.when(text.rlike(ANY_SHAPE), _parse_any(text)))


def _parse_any(text: Column) -> Column:
    date, clock, offset = (F.regexp_extract(text, ANY_SHAPE, i) for i in (1, 2, 3))
    moment = F.unix_micros(_midnight(F.regexp_replace(date, "-", ""))) + _clock_micros(clock)
    ahead = F.when(offset.rlike("^[+-]"), _clock_micros(F.substring(offset, 2, 40))).otherwise(0)
    return F.timestamp_micros(moment - F.when(offset.startswith("-"), -ahead).otherwise(ahead))


def _midnight(date: Column) -> Column:
    """Start of a compact calendar date (yyyyMMdd) or week date (yyyyWww, yyyyWwwd); null if there is no such day."""
    calendar = F.try_to_timestamp(F.concat_ws("-", *[F.substring(date, at, size) for at, size in ((1, 4), (5, 2), (7, 2))]))
    year, week = F.substring(date, 1, 4).try_cast("int"), F.substring(date, 6, 2).try_cast("int")
    day = F.when(F.length(date) == 8, F.substring(date, 8, 1)).otherwise("1").try_cast("int")
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # is always in the first week
    monday = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth))
    # A week belongs to the year that has its Thursday.
    exists = (week >= 1) & (F.year(F.date_add(monday, 3)) == year) & day.between(1, 7) & (F.year(F.date_add(monday, day - 1)) <= 9999)
    by_week = F.when(exists, F.date_add(monday, day - 1).cast("timestamp"))
    return F.when(date.contains("W"), by_week).otherwise(calendar)


def _clock_micros(clock: Column) -> Column:
    """Microseconds of a time of day or an offset without sign; 0 for empty text."""
    whole = F.regexp_replace(F.regexp_extract(clock, "^[0-9:]*", 0), ":", "")
    part = F.rpad(F.substring(F.regexp_extract(clock, "[.,]([0-9]+)$", 1), 1, 6), 6, "0")
    hours, minutes, seconds = (F.coalesce(F.substring(whole, at, 2).try_cast("long"), F.lit(0)) for at in (1, 3, 5))
    return ((hours * 60 + minutes) * 60 + seconds) * 1_000_000 + F.coalesce(part.try_cast("long"), F.lit(0))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for exact integer window arithmetic."""
    return F.unix_micros(ts.cast("timestamp"))


def iso_text(ts: Column) -> Column:
    """ISO text of a timestamp without zone; the fraction is left out when it is zero."""
    fraction = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
    )
