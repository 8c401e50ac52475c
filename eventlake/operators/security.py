"""Failed-login bursts, risk scores and policy decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.cases import first_match
from eventlake.functions.json_safe import computed_once
from eventlake.functions.text import is_empty
from eventlake.functions.times import micros, parse_iso
from eventlake.operators.numbering import block_of_place, block_starts, in_blocks
from eventlake.schemas import SECURITY_SCHEMA

# Detector defaults, score steps, level and policy bounds with their texts.
FAILED_LOGIN = "LOGIN_FAILED"
THRESHOLD = 5
WINDOW_SECONDS = 60
ATTEMPT_POINTS = ((5, 30), (10, 20), (20, 20))
ADDRESS_POINTS = 10
MAX_SCORE = 100
LEVELS = ((80, "HIGH"), (50, "MEDIUM"), (0, "LOW"))
POLICIES = (
    (80, "DISABLE_USER", "High risk brute force"),
    (50, "ALERT", "Medium risk brute force"),
    (0, "LOG", "Low risk suspicious activity"),
)


def parse_security_events(records: DataFrame, value: str = "value") -> DataFrame:
    """JSON security events with ``ets``, the event time. Other columns of the record are kept.

    Unreadable messages and times leave ``ets`` null: see ``readable_events`` and ``unreadable_events``.
    """
    event = F.from_json(F.col(value).cast("string"), SECURITY_SCHEMA)
    kept = [c for c in records.columns if c != value]
    parsed = records.select(*kept, value, computed_once(event).alias("_event"))
    return parsed.select(*kept, value, "_event.*").withColumn("ets", parse_iso(F.col("timestamp")))


def readable_events(parsed: DataFrame, value: str = "value") -> DataFrame:
    return parsed.where(F.col("ets").isNotNull()).drop(value)


def unreadable_events(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Messages the job skips, with the reason; they never stop it."""
    reason = F.when(F.col("timestamp").isNull(), "no event time or not JSON").otherwise("bad event time")
    kept = [c for c in parsed.columns if c not in SECURITY_SCHEMA.fieldNames() and c != "ets"]
    return parsed.where(F.col("ets").isNull()).select(*kept, reason.alias("reason"))


def failed_logins(events: DataFrame) -> DataFrame:
    """Failed logins that name a user."""
    return events.where((F.col("event_type") == FAILED_LOGIN) & ~is_empty(F.col("username")))


def sliding_counts(
    rows: DataFrame, window_micros: int, key: str = "username", seq: str = "seq", ts: str = "ets_us", blocks: int | None = None
) -> DataFrame:
    """``attempts``: rows of the same key in the trailing window, in arrival order.

    The window keeps attempts until one arrives whose time is more than ``window_micros`` later
    than the oldest kept one; late rows wait behind newer ones. ``seq`` must be unique and
    integral, ``ts`` is in microseconds.

    With mx the running maximum of event time in arrival order, the attempts that have left the
    window by a row are those whose mx lies more than the window before the row's mx. Arrivals are
    dealt into blocks of equal depth along (key, ``seq``): running maximum and position are local
    values plus what the earlier blocks contribute. The count of those that left is a rank lookup of
    ``mx - window`` among the key's mx values: equal mx values of a block are first collapsed to one
    row, then dealt into blocks along (key, mx), again local rank plus earlier blocks. So a key of any
    size is spread, and neither a stray number nor a stray time makes a long block.
    """
    placed = in_blocks(rows, [key], [seq], blocks, settle=False).withColumn("_block", block_of_place())
    starts = block_starts(placed, [key], "_block", F.count(F.lit(1)), (F.max(ts), "_mx_before"))
    local = Window.partitionBy(key, "_block").orderBy("_at")
    running = (
        placed.withColumn("_mx", F.max(ts).over(local.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_arrived", F.row_number().over(local))
        .join(starts, [key, "_block"])
        .withColumn("_mx", F.greatest("_mx", "_mx_before"))
        .withColumn("_arrived", F.col("_arrived") + F.col("rows_before"))
        .drop("rows_before", "_mx_before", "_at")
    )

    levels = running.groupBy(key, "_block", "_mx").agg(F.count(F.lit(1)).alias("_n"))
    # Each level is a mark that counts its rows and a probe that asks how many rows lie below it.
    # Probes sort before marks of the same time, so only strictly earlier marks count.
    mark = F.struct(F.col("_mx").alias("_time"), F.col("_n").alias("_rows"), F.lit(1).alias("_is_mark"))
    probe = F.struct((F.col("_mx") - window_micros).alias("_time"), F.lit(0).cast("long").alias("_rows"), F.lit(0).alias("_is_mark"))
    points = levels.select(key, "_block", "_mx", F.inline(F.array(mark, probe)))
    sliced = in_blocks(points, [key], ["_time", "_is_mark"], blocks, settle=False).withColumn("_slice", block_of_place())
    slices = block_starts(sliced, [key], "_slice", F.sum("_rows"))
    within = Window.partitionBy(key, "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    expired = (
        sliced.withColumn("_below", F.sum("_rows").over(within))
        .where(F.col("_is_mark") == 0)
        .join(slices, [key, "_slice"])
        .select(key, "_block", "_mx", (F.col("_below") + F.col("rows_before")).alias("_expired"))
    )
    counted = running.join(expired, [key, "_block", "_mx"]).drop("_block", "_mx")
    return counted.withColumn("attempts", F.col("_arrived") - F.col("_expired")).drop("_arrived", "_expired")


def bruteforce_incidents(
    events: DataFrame,
    threshold: int = THRESHOLD,
    window_seconds: int = WINDOW_SECONDS,
    seq: str = "seq",
    blocks: int | None = None,
) -> DataFrame:
    """One incident for every failed login at or above the threshold; nothing resets the count.

    ``events`` has ``ets`` and an arrival number ``seq``. Across unkeyed topic partitions arrival
    order is not defined by the broker, so the caller decides what ``seq`` is.
    """
    attempts = failed_logins(events).where(F.col("ets").isNotNull()).select(
        seq, "username", "ip_address", "client_id", "realm", micros(F.col("ets")).alias("ets_us")
    )
    counted = sliding_counts(attempts, window_seconds * 1_000_000, seq=seq, blocks=blocks)
    return incident_rows(counted, threshold, window_seconds, seq)


def incident_rows(counted: DataFrame, threshold: int, window_seconds: int, seq: str = "seq") -> DataFrame:
    return counted.where(F.col("attempts") >= threshold).select(
        seq,
        "username",
        F.col("attempts").alias("failed_attempts"),
        F.lit(window_seconds).alias("window_seconds"),
        "ip_address",
        "client_id",
        "realm",
    )


def risk_scores(incidents: DataFrame) -> DataFrame:
    """Points for each attempt bound reached and for a known address, capped, with a level."""
    points = F.when(~is_empty(F.col("ip_address")), ADDRESS_POINTS).otherwise(0)
    for bound, value in ATTEMPT_POINTS:
        points = points + F.when(F.col("failed_attempts") >= bound, value).otherwise(0)
    scored = incidents.withColumn("risk_score", F.least(points, F.lit(MAX_SCORE)))
    return scored.withColumn("risk_level", _of_band(LEVELS))


def policy_decisions(scored: DataFrame) -> DataFrame:
    return scored.withColumn("action", _of_band([(low, action) for low, action, _ in POLICIES])).withColumn(
        "reason", _of_band([(low, reason) for low, _, reason in POLICIES])
    )


def _of_band(bands: Sequence[tuple[int, str]]) -> Column:
    """Text of the first band whose lower bound the score reaches; the last band takes the rest."""
    *upper, (_, rest) = bands
    return first_match(((F.col("risk_score") >= low, text) for low, text in upper), rest)


def dry_run_disables(decided: DataFrame) -> DataFrame:
    """Users that a live policy would disable; nothing is disabled here."""
    return decided.where(F.col("action") == "DISABLE_USER")
