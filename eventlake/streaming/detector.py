"""Failed-login bursts on a stream, with counts that go on across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.functions.times import micros
from eventlake.operators.security import THRESHOLD, WINDOW_SECONDS, failed_logins

_DETAILS = ("ip_address", "client_id", "realm")
INCIDENT_SCHEMA = (
    "seq long, username string, failed_attempts long, window_seconds int, ip_address string, client_id string, realm string"
)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Bursts(StatefulProcessor):
    """The attempts of one user that may still count.

    ``highs`` has the running maximum of event time at each attempt, in order of arrival: a list that never falls, so
    the attempts that have left the window are a leading part of it. New attempts are appended; ``spent`` tells how many
    leading entries have left, and the list is written anew only when they are more than half of it.
    """

    def __init__(self, threshold: int, window_seconds: int, idle_seconds: int | None):
        self.threshold, self.window_seconds, self.idle_seconds = threshold, window_seconds, idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.highs = handle.getListState("highs", "high long")
        self.spent = handle.getValueState("spent", "entries long, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(rows).sort_values("seq")
        spent, due = self.spent.get() if self.spent.exists() else (0, None)
        known = np.fromiter((row[0] for row in self.highs.get()), np.int64)
        highs = np.concatenate([known[spent:], batch["ets_us"].to_numpy(np.int64)])
        live = len(known) - spent
        highs = np.maximum.accumulate(highs)
        gone = np.searchsorted(highs, highs - self.window_seconds * 1_000_000, side="left")
        counts = (np.arange(1, len(highs) + 1) - gone)[live:]
        spent += int(gone[-1])
        if 2 * spent > len(known) + len(batch):
            self.highs.put([(int(high),) for high in highs[gone[-1] :]])
            spent = 0
        else:
            self.highs.appendList([(int(high),) for high in highs[live:]])
        if self.idle_seconds is not None:
            if due is not None:
                self.handle.deleteTimer(due)
            due = int(highs[-1]) // 1000 + self.idle_seconds * 1000
            self.handle.registerTimer(due)
        self.spent.update((spent, due))
        batch = batch.assign(failed_attempts=counts, window_seconds=self.window_seconds)
        names = ["seq", "username", "failed_attempts", "window_seconds", *_DETAILS]
        yield batch.loc[batch["failed_attempts"] >= self.threshold, names]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.highs.clear()
        self.spent.clear()
        return iter([])

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession):
    """State of the queries started inside is kept in RocksDB, which list state and timers need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def incident_stream(
    events: DataFrame,
    threshold: int = THRESHOLD,
    window_seconds: int = WINDOW_SECONDS,
    idle_seconds: int | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Incidents of a stream of security events with ``seq`` and ``ets``; start it inside ``rocksdb``.

    Spark keeps the live attempts of each user in its state store, so a batch touches only the users it has events of.
    ``seq`` must grow from one batch to the next. The result is the one of the batch operator.

    With ``idle_seconds``, at least the window, a user's state is dropped once the watermark (the newest event time less
    ``delay``) is that far beyond the user's newest attempt: a later attempt would find none of them in its window.
    Events that come behind the watermark are then dropped as well. One user's events of a batch are in one task.
    """
    if idle_seconds is not None and idle_seconds < window_seconds:
        raise ValueError(f"idle users are kept for the window at least: {idle_seconds} < {window_seconds}")
    attempts = failed_logins(events).where(F.col("ets").isNotNull())
    columns = ["seq", "username", *_DETAILS, micros(F.col("ets")).alias("ets_us")]
    if idle_seconds is not None:
        attempts = attempts.withColumn("_at", F.col("ets").cast("timestamp")).withWatermark("_at", delay)
        columns.append("_at")
    return attempts.select(*columns).groupBy("username").transformWithStateInPandas(
        Bursts(threshold, window_seconds, idle_seconds), INCIDENT_SCHEMA, "append", "none" if idle_seconds is None else "eventtime"
    )
