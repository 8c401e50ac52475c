import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from eventlake.operators import security

def replay(rows, window):
    """Counts by keeping each user's attempts in a queue, one event at a time."""
    queues, counts = defaultdict(deque), {}
    for user, seq, ts in sorted(rows, key=lambda r: r[1]):
        queue = queues[user]
        queue.append(ts)
        while queue[0] < ts - window:
            queue.popleft()
        counts[seq] = len(queue)
    return counts


def random_rows(seed, users=25, events=1500):
    rng = random.Random(seed)
    rows, clock = [], defaultdict(int)
    for seq in range(events):
        user = "busy" if rng.random() < 0.35 else f"u{rng.randrange(users)}"
        clock[user] += rng.choice([0, 0, 1, 3, 10, 40, 200])
        late = rng.choice([0, 0, 0, 5, 30, 300])
        jump = 100_000 if rng.random() < 0.001 else 0  # one far-future time ages everything before it
        rows.append((user, seq, clock[user] - late + jump))
    return rows


@pytest.mark.parametrize(
    "options",
    [{}, {"blocks": 1}, {"blocks": 4}, {"blocks": 23}, {"blocks": 150}],
)
@pytest.mark.parametrize("window", [0, 60])
def test_counts_equal_a_replay(spark, options, window):
    rows = random_rows(window + options.get("blocks", 0))
    df = spark.createDataFrame(rows, "username string, seq long, ets_us long")
    got = {r.seq: r.attempts for r in security.sliding_counts(df, window, **options).collect()}
    assert got == replay(rows, window)


def test_negative_times_and_sparse_order(spark):
    rows = [("a", seq * 977, ts) for seq, ts in enumerate([-50, -3, -60, 0, 2, -1, 55, 55, 61])]
    df = spark.createDataFrame(rows, "username string, seq long, ets_us long")
    for options in ({}, {"blocks": 5}):
        got = {r.seq: r.attempts for r in security.sliding_counts(df, 60, **options).collect()}
        assert got == replay(rows, 60)


def test_one_stray_number_and_one_stray_time_leave_blocks_even(spark):
    rows = [("busy", seq, 10 * seq) for seq in range(4000)] + [("busy", 10**17, 20_000), ("busy", 10**17 + 1, -(10**15))]
    df = spark.createDataFrame(rows, "username string, seq long, ets_us long")
    got = {r.seq: r.attempts for r in security.sliding_counts(df, 100, blocks=8).collect()}
    assert got == replay(rows, 100)


def burst(spark, n, ip):
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ets"),
        F.lit("LOGIN_FAILED").alias("event_type"),
        F.lit("user1").alias("username"),
        F.lit(ip).cast("string").alias("ip_address"),
        F.lit("usage-api").alias("client_id"),
        F.lit("main").alias("realm"),
    )


def test_twenty_failures_in_a_row(spark):
    decided = security.policy_decisions(security.risk_scores(security.bruteforce_incidents(burst(spark, 20, "10.0.0.1"))))
    rows = [tuple(r) for r in decided.orderBy("seq").select("failed_attempts", "risk_score", "risk_level", "action").collect()]
    assert rows == (
        [(n, 40, "LOW", "LOG") for n in range(5, 10)]
        + [(n, 60, "MEDIUM", "ALERT") for n in range(10, 20)]
        + [(20, 80, "HIGH", "DISABLE_USER")]
    )
    assert security.dry_run_disables(decided).count() == 1


def test_without_an_address_the_top_level_is_out_of_reach(spark):
    scored = security.risk_scores(security.bruteforce_incidents(burst(spark, 30, None), window_seconds=600))
    assert {r.risk_score for r in scored.collect()} == {30, 50, 70}
    assert {r.risk_level for r in scored.collect()} == {"LOW", "MEDIUM"}


def test_only_failed_logins_with_a_user_count(spark):
    events = spark.createDataFrame(
        [("LOGIN_FAILED", "u"), ("LOGIN_FAILED", ""), ("LOGIN_FAILED", None), ("LOGIN", "u"), (None, "u")],
        "event_type string, username string",
    )
    assert security.failed_logins(events).count() == 1


def test_unreadable_messages_are_set_aside(spark):
    records = spark.createDataFrame(
        [
            (1, '{"event_type":"LOGIN","timestamp":"2024-01-01T00:00:00Z"}'),
            (2, '{"event_type":"LOGIN","timestamp":"2024-01-01T00:00:00.5"}'),
            (3, '{"event_type":"LOGIN","timestamp":"2024-01-01T09:00:00+09:00"}'),
            (4, '{"event_type":"LOGIN","timestamp":"soon"}'),
            (5, '{"event_type":"LOGIN"}'),
            (6, "{bad"),
            (7, None),
        ],
        "seq long, value string",
    )
    parsed = security.parse_security_events(records)
    times = {r.seq: r.us for r in security.readable_events(parsed).select("seq", F.unix_micros("ets").alias("us")).collect()}
    start = 1_704_067_200_000_000
    assert times == {1: start, 2: start + 500_000, 3: start}
    reasons = {r.seq: r.reason for r in security.unreadable_events(parsed).collect()}
    assert reasons == {4: "bad event time", **{n: "no event time or not JSON" for n in (5, 6, 7)}}
