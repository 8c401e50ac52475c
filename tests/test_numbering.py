"""Key hash vectors, dense offsets, blocks of equal depth, and exact retention."""

import os
import random
import weakref
from collections import Counter, OrderedDict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake.functions.keys import key_partition, murmur2
from eventlake.operators import retention, status, topics
from eventlake.operators.numbering import block_of_place, block_starts, dense_numbers, in_blocks
from eventlake.sinks.topics import publish_in_order, read_log

# Published vectors of the hash, as signed numbers.
VECTORS = {
    "21": -973932308,
    "foobar": -790332482,
    "a-little-bit-long-string": -985981536,
    "a-little-bit-longer-string": -1486304829,
    "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
    "abc": 479470107,
}


def hash_of(data: bytes) -> int:
    """The hash in plain integers."""
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = 0x9747B28C ^ len(data)
    cut = len(data) // 4 * 4
    for i in range(0, cut, 4):
        k = int.from_bytes(data[i : i + 4], "little") * m & mask
        k = (k ^ k >> 24) * m & mask
        h = (h * m & mask) ^ k
    if data[cut:]:
        h = (h ^ int.from_bytes(data[cut:], "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


def test_published_vectors(spark):
    rows = spark.createDataFrame([(k,) for k in VECTORS], "k string").select("k", murmur2(F.col("k")).alias("h")).collect()
    assert {r.k: r.h - 2**32 if r.h >= 2**31 else r.h for r in rows} == VECTORS


def test_any_text(spark):
    draw = random.Random(3)
    keys = ["", "é", "\U0001f600", *("".join(draw.choices("aZ é€\U0001f600\x00", k=n)) for n in range(1, 40))]
    rows = spark.createDataFrame([(k,) for k in [*keys, None]], "k string").select("k", murmur2(F.col("k")).alias("h"), key_partition(F.col("k"), 7).alias("p")).collect()
    for r in rows:
        assert (r.h, r.p) == ((None, None) if r.k is None else (hash_of(r.k.encode()), (hash_of(r.k.encode()) & 0x7FFFFFFF) % 7))


def plain_offsets(rows, ends):
    counts, out = Counter(ends), {}
    for topic, partition, seq in sorted(rows, key=lambda r: r[2]):
        out[seq] = counts[topic, partition]
        counts[topic, partition] += 1
    return out


@pytest.mark.parametrize("blocks", [None, 1, 13])
def test_offsets_equal_a_plain_count(spark, blocks):
    draw = random.Random(11)
    rows = [(draw.choice(["a", "b", None]), draw.choice([0, 0, 0, 1, None]), seq) for seq in draw.sample(range(-10**12, 10**12), 900)]
    frame = spark.createDataFrame(rows, "topic string, partition int, seq long").withColumn("offset_text", F.lit("x"))
    ends = spark.createDataFrame([("a", 0, 50), (None, 1, 7), ("other", 0, 9)], "topic string, partition int, offset long")
    got = {r.seq: r.offset for r in topics.record_offsets(frame, ends=ends, blocks=blocks).collect()}
    assert got == plain_offsets(rows, {("a", 0): 50, (None, 1): 7})
    assert dense_numbers(frame.limit(0), ["topic"], ["seq"]).count() == 0


def test_a_partition_with_half_of_the_rows_is_spread(spark):
    records = spark.range(0, 80_000, 1, 8).select(F.col("id").alias("seq"), F.lit("t").alias("topic"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 97).cast("int").alias("partition"))
    placed = in_blocks(records, ["topic", "partition"], ["seq"], 16)
    sizes = [r["count"] for r in placed.groupBy(block_of_place()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 80_000 / 16


def test_a_stray_value_makes_no_long_block(spark):
    values = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") == 7, 10**18).otherwise(F.col("id")).alias("seq"))
    sizes = [r["count"] for r in in_blocks(values, [], ["seq"], 8).groupBy(block_of_place()).count().collect()]
    assert max(sizes) < 2 * 40_000 / 8


def test_starts_sum_up_earlier_blocks(spark):
    rows = spark.range(100).selectExpr("id % 2 AS key", "id div 10 AS b", "id")
    got = {(r.key, r.b): (r.rows_before, r.top) for r in block_starts(rows, ["key"], "b", F.count(F.lit(1)), (F.max("id"), "top")).collect()}
    assert got[(0, 0)] == (0, None) and got[(1, 3)] == (15, 29) and got[(0, 9)] == (45, 88)


def test_published_records_keep_the_order_of_their_key(spark, folder):
    rows = [(f"k{i % 5}" if i % 11 else None, f"v{i}", i) for i in range(300)]
    frame = spark.createDataFrame(rows, "key string, value string, seq long")
    assert read_log(spark, f"{folder}/log").count() == 0
    for low, high in ((0, 120), (120, 120), (120, 300)):
        part = frame.where((F.col("seq") >= low) & (F.col("seq") < high))
        places = publish_in_order(part, f"{folder}/log", "t", 3).collect()
        assert len(places) == high - low
    log = read_log(spark, f"{folder}/log").collect()
    assert sorted((r.key or "", r.value) for r in log) == sorted((k or "", v) for k, v, _ in rows)
    for partition in range(3):
        own = sorted((r.offset, int(r.value[1:])) for r in log if r.partition == partition)
        assert [o for o, _ in own] == list(range(len(own))) and own == sorted(own, key=lambda x: x[1])
    assert len({(r.key, r.partition) for r in log if r.key}) == 5


# Exact retention


def plain_retained(created, messages, keep):
    rows = sorted([(a, 0, e) for e, a in created] + [(a, 1, e) for e, a in messages])
    held = OrderedDict()
    for arrival, kind, event in rows:
        if kind == 0:
            held.pop(event, None)
            held[event] = (arrival, arrival, 0)
            if len(held) > keep:
                held.popitem(last=False)
        elif event in held:
            _, first, n = held.pop(event)
            held[event] = (arrival, first, n + 1)
    return sorted((e, *v) for e, v in held.items())


@pytest.mark.parametrize("seed, blocks, keep", [(0, 1, 3), (1, 7, 5), (2, 24, 20), (3, 9, 1), (4, 12, 400)])
def test_retained_equal_to_a_replay(spark, seed, blocks, keep):
    draw = random.Random(seed)
    created = [(f"e{draw.randrange(60)}", draw.randrange(3000)) for _ in range(150)]
    # Messages come before, soon after, or long after their event; some events are named all the time.
    messages = [(f"e{draw.choice([draw.randrange(70), 1, 2])}", draw.randrange(3000)) for _ in range(700)]
    events = spark.createDataFrame([*created, (None, 5)], "event_id string, created_arrival long")
    said = spark.createDataFrame([*messages, (None, 9), ("e1", None)], "event_id string, arrival long")
    got = sorted(tuple(r) for r in status.retained_events(events, said, keep, blocks=blocks).collect())
    assert got == plain_retained(created, messages, keep)


@pytest.mark.parametrize("seed", range(3))
def test_only_the_tail_is_read_if_nothing_reaches_back(spark, seed):
    draw = random.Random(seed)
    created = [(f"e{i}", 10 * i) for i in range(4000)]
    # The state of a long past is irrelevant; late messages there are never looked at.
    messages = [(f"e{draw.randrange(i + 1)}", 10 * i + 1) for i in range(1000)]
    messages += [(f"e{i - draw.randrange(min(i, 12))}", 10 * i + 2) for i in range(1, 4000)] + [("unknown", 39_999)]
    events = spark.createDataFrame(created, "event_id string, created_arrival long")
    said = spark.createDataFrame(messages, "event_id string, arrival long")
    past = retention.history(events, said, 10, blocks=5)
    assert sorted(tuple(r) for r in past.held.collect()) == plain_retained(created, messages, 10)


def test_a_tail_that_nothing_reaches_back_from(spark):
    created = [(f"e{i}", 10 * i) for i in range(4000)] + [("stray", 10**15)]
    messages = [(f"e{i}", 10 * i + step) for i in range(4000) for step in (1, 2)] + [("unknown", 39_995)]
    events = spark.createDataFrame(created, "event_id string, created_arrival long")
    said = spark.createDataFrame(messages, "event_id string, arrival long")
    past = retention.history(events, said, 10)
    assert sorted(tuple(r) for r in past.held.collect()) == plain_retained(created, messages, 10)
    assert past.rows.count() < len(created) + len(messages)


def test_rounds_go_on_while_blocks_hand_over_something_else(spark):
    """One event lives on by its messages through all blocks, and nothing else is created for long."""
    events = spark.createDataFrame([("old", 0), ("other", 1)], "event_id string, created_arrival long")
    said = spark.createDataFrame([("old", i) for i in range(2, 200)], "event_id string, arrival long")
    got = sorted(tuple(r) for r in status.retained_events(events, said, 2, blocks=10).collect())
    assert got == [("old", 199, 0, 198), ("other", 1, 1, 0)]


def test_a_block_is_replayed_batch_by_batch():
    """Rows are asked for one batch at a time, and no batch is kept; cuts do not matter."""
    draw = random.Random(4)
    given = [(1, rank - 9, f"e{rank}", rank, None, rank, 2) for rank in range(4)]
    rows = given + [(block, at, f"e{draw.randrange(12)}", 10 + at, draw.random() < 0.3, None, None) for block in (1, 2) for at in range(200)]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
    held = {1: OrderedDict((e, (t, c, n)) for _, _, e, t, _, c, n in given), 2: OrderedDict()}
    for block in (1, 2):
        own = [r for r in rows if r[0] == block and r[4] is not None]
        retention.replay(*zip(*[(r[2], r[3], r[4]) for r in own]), held[block], 5)
    want = [(block, rank, e, *v) for block in (1, 2) for rank, (e, v) in enumerate(held[block].items())]
    for cut in (1, 3, 50, 1000):
        passed = []

        def batches():
            for i in range(0, len(rows), cut):
                batch = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[i : i + cut]), kinds)], names=list("abcdefg"))
                passed.append(weakref.ref(batch))
                assert sum(p() is not None for p in passed) <= 2
                yield batch

        got = [r for out in retention.handed_over(batches(), 5) for r in zip(*(out.column(k).to_pylist() for k in range(6)))]
        assert got == want


def steady_load(n, seed=0):
    """Every event is created, and every third is heard of again 2 to 14 events later: no place is free of overlaps."""
    draw = random.Random(seed)
    created = [(f"e{i}", 10 * i) for i in range(n)] + [(f"e{i}", 10 * i + 300) for i in range(0, n, 40)]
    messages = [(f"e{i}", 10 * i + 1 + (draw.randrange(2, 15) * 10 if i % 3 == 0 else 0)) for i in range(n) for _ in range(2)]
    return created, messages


def folders(spark, *kinds):
    shared = os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return {name for name in shared if name.split("-")[0] in kinds}


def test_a_tail_is_enough_if_messages_reach_back_over_every_cut(spark):
    created, messages = steady_load(4000)
    events = spark.createDataFrame(created, "event_id string, created_arrival long")
    said = spark.createDataFrame(messages, "event_id string, arrival long")
    before = folders(spark, "rows", "tail")
    past = retention.history(events, said, 10)
    assert sorted(tuple(r) for r in past.held.collect()) == plain_retained(created, messages, 10)
    assert past.rows.count() < (len(created) + len(messages)) / 2
    assert len(folders(spark, "rows", "tail") - before) == 1


def test_a_tail_in_many_short_pieces_is_enough(spark):
    """What one of 200 pieces holds is too little to tell what is held after it; they are merged."""
    created, messages = steady_load(4000)
    events = spark.createDataFrame(created, "event_id string, created_arrival long")
    said = spark.createDataFrame(messages, "event_id string, arrival long")
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 200)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        past = retention.history(events, said, 10)
        assert sorted(tuple(r) for r in past.held.collect()) == plain_retained(created, messages, 10)
        assert past.rows.select(block_of_place()).distinct().count() > 100
        assert past.rows.count() < (len(created) + len(messages)) / 2
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("share", [None, 0])
def test_blocks_stay_whole_where_skewed_joins_are_split(spark, monkeypatch, share):
    if share is not None:
        monkeypatch.setattr(retention, "_cut", lambda made, keep: None)
        monkeypatch.setattr(retention, "LAST_SHARE", share)
    created, messages = steady_load(8000)
    events = spark.createDataFrame(created, "event_id string, created_arrival long")
    said = spark.createDataFrame(messages, "event_id string, arrival long")
    settings = {
        "spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    was = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = sorted(tuple(r) for r in retention.history(events, said, 10).held.collect())
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == plain_retained(created, messages, 10)


def test_blocks_are_merged_up_to_a_length(monkeypatch):
    assert retention._merged([(10, 10)] * 8, 1000) == 3 and retention._merged([(10, 10)] * 5, 1000) == 3
    assert retention._merged([(640, 64)] * 8, 1) == 0 and retention._merged([(640, 32)] * 8, 1) == 1
    monkeypatch.setattr(retention, "LONG_BLOCK", 20)
    assert retention._merged([(10, 1)] * 8, 1000) == 1


def test_the_whole_history_comes_second_if_its_end_depends_on_its_beginning(spark):
    """Of three that may be held, one is created all the time and one only named: nothing drives out the third."""
    created = [("old", 0), ("kept", 1), *[("again", 10 * i) for i in range(1, 4000)]]
    messages = [("kept", 10 * i + 1) for i in range(1, 4000)]
    events = spark.createDataFrame(created, "event_id string, created_arrival long")
    said = spark.createDataFrame(messages, "event_id string, arrival long")
    before = folders(spark, "rows", "tail")
    past = retention.history(events, said, 3, blocks=5)
    assert sorted(tuple(r) for r in past.held.collect()) == plain_retained(created, messages, 3)
    assert past.rows.count() == len(created) + len(messages)
    assert len(folders(spark, "rows", "tail") - before) == 2


@pytest.mark.parametrize("share", [0, 1 / 16, 1 / 3])
def test_the_last_blocks_of_a_whole_history_may_be_enough(spark, monkeypatch, share):
    monkeypatch.setattr(retention, "_cut", lambda made, keep: None)
    monkeypatch.setattr(retention, "LAST_SHARE", share)
    created, messages = steady_load(600, 1)
    events = spark.createDataFrame(created, "event_id string, created_arrival long")
    said = spark.createDataFrame(messages, "event_id string, arrival long")
    got = sorted(tuple(r) for r in status.retained_events(events, said, 10, blocks=20).collect())
    assert got == plain_retained(created, messages, 10)


@pytest.mark.parametrize("far", [0, 1, 16])
def test_doubt_ends_only_where_no_start_matters(monkeypatch, far):
    monkeypatch.setattr(retention, "FAR_TIMES", far)
    ended = 0
    for seed in range(400):
        draw = random.Random(seed)
        keep, share, pool = draw.choice([1, 2, 3, 6]), draw.choice([0.1, 0.4]), [f"e{i}" for i in range(draw.choice([3, 9, 20]))]
        rows = [(draw.choice(pool), 100 + i, draw.random() < share) for i in range(draw.choice([10, 40, 150]))]
        if seed % 2:  # new events all the time, named some time later
            rows = [(f"e{i}" if new else f"e{i - draw.randrange(1, 3 * keep + 4)}", at, new) for i, (_, at, new) in enumerate(rows)]
        ids, arrivals, made = zip(*rows)
        cut, doubt = draw.randrange(len(rows)), retention.Doubt(keep)
        if doubt.ends(ids[:cut], made[:cut]) or doubt.ends(ids[cut:], made[cut:]):
            ended += 1
            want = list(retention.replay(ids, arrivals, made, OrderedDict(), keep).items())
            for _ in range(30):
                start = draw.sample([*pool, "other", *(f"e{-i}" for i in range(1, 20))], draw.randrange(keep + 1))
                held = OrderedDict((e, (at, draw.randrange(50), 1)) for at, e in enumerate(start))
                assert list(retention.replay(ids, arrivals, made, held, keep).items()) == want
        assert len(doubt.near) <= keep and len(doubt.touched) <= keep and len(doubt.far) <= far * keep
    assert ended > 100


def test_nothing_happened(spark):
    events = spark.createDataFrame([], "event_id string, created_arrival long")
    said = spark.createDataFrame([], "event_id string, stage string, status string, arrival long")
    assert status.retained_events(events, said).count() == 0
    assert status.recent_events(events, said).count() == 0


def test_recent_events_count_only_what_the_state_heard(spark):
    events = spark.createDataFrame([("a", 1), ("b", 2), ("c", 4), ("a", 6)], "event_id string, created_arrival long")
    said = spark.createDataFrame(
        [("a", "spark", "failed", 3), ("b", "kafka", "failed", 5), ("b", "spark", "failed", 7), ("a", "kafka", "completed", 8)],
        "event_id string, stage string, status string, arrival long",
    )
    # With two held: a(1) b(2) a-touch(3), c(4) evicts b, b's messages are lost, a is created again at 6.
    got = {(r.event_id, r.stage): (r.status, r.touched_arrival) for r in status.recent_events(events, said, keep=2).collect()}
    assert {e for e, _ in got} == {"a", "c"}
    assert got["a", "spark"] == ("waiting", 8) and got["a", "kafka"] == ("completed", 8) and got["c", "kafka"] == ("processing", 4)


def test_messages_are_parsed_once(spark):
    from eventlake.plans import catalog

    small = "/root/testdata/sf0.001"
    for name, most in (("pipeline_state", 1), ("pipeline_recent", 0), ("pipeline_retained", 0)):
        plan = catalog.all_queries()[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") + plan.count("JsonToStructs") <= most, name


def test_history_is_not_ordered_in_one_partition(spark):
    made = spark.range(0, 20_000, 1, 8).select(F.concat(F.lit("e"), "id").alias("event_id"), (F.col("id") * 10).alias("created_arrival"))
    said = made.select("event_id", (F.col("created_arrival") + 3).alias("arrival"))
    past = retention.history(made, said, 100, blocks=8)
    sizes = [r["count"] for r in past.rows.groupBy(block_of_place()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * past.rows.count() / 8
