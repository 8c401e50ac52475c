"""Stage and status vocabulary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.functions.cases import first_match

# The five stages in order, the state a new event starts in, and status synonyms.
STAGES = ("fastapi", "kafka", "spark", "iceberg", "minio")
INITIAL_STATUS = {
    "fastapi": "completed",
    "kafka": "processing",
    "spark": "waiting",
    "iceberg": "waiting",
    "minio": "waiting",
}
SYNONYMS = {
    "completed": ("completed", "complete", "success", "succeeded"),
    "processing": ("processing", "running", "in_progress"),
    "failed": ("failed", "error"),
    "waiting": ("waiting", "pending", "queued"),
}
UNKNOWN = "unknown"


def normalized_status(status: Column) -> Column:
    """One of the four states, or ``unknown``; letter case does not matter."""
    word = F.lower(status)
    return first_match(((word.isin(*words), state) for state, words in SYNONYMS.items()), UNKNOWN)
