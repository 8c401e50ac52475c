"""The events a bounded state still holds: evicted when a newer one is created, deaf to messages from then on.

Creating an event puts it in front and evicts the least recently touched one beyond the limit; a message touches its
event only if that is still held. What a stretch of the history does depends on what came before only through the at
most ``keep`` events held at its start. So the history is dealt into ordered blocks that are replayed side by side,
each from a guess of what is held at its start, and a block is replayed again only while what its forerunner hands over
differs from the guess. A block in which many events are created hands over the same whatever it was given, so two or
three rounds do; when nothing differs any more, the outcome is that of one replay in order.

The history need not be replayed from its beginning: a stretch after which nothing depends on what was held before it
(``Doubt`` tells) ends in the same state wherever it started from. That also holds where messages reach back over every
place at which the history could be cut. One tail is tried; if it depends on its start, the whole history is dealt.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.numbering import block_of_place, in_blocks, written

HELD = "block long, rank int, event_id string, touched_arrival long, created_arrival long, messages long, sure boolean"
CREATED = "_created"
# A tail, and a block where there are enough, has at least so many times the creations that are held; a tail also has
# this share of all.
TAIL_TIMES = 64
TAIL_SHARE = 1 / 256
# Of the blocks of a whole history, the last so many are looked at first.
LAST_SHARE = 1 / 16
# Blocks of so many rows are not merged, however few their creations.
LONG_BLOCK = 2**18
# Ids that may be held beyond the latest ones are told apart up to so many times the number held.
FAR_TIMES = 16


@dataclass(frozen=True)
class History:
    """``rows``: the creations and messages that decided it, to be read again; ``held``: the events held at the end."""

    rows: DataFrame
    held: DataFrame


def replay(ids: list[str], arrivals: list[int], created: list[bool], held: OrderedDict, keep: int) -> OrderedDict:
    """One block of the history, in order; ``held`` maps ids to (touched, created, messages), oldest touch first."""
    for event_id, arrival, is_new in zip(ids, arrivals, created):
        if is_new:
            held.pop(event_id, None)
            held[event_id] = (arrival, arrival, 0)
            if len(held) > keep:
                held.popitem(last=False)
        elif event_id in held:
            _, first, messages = held.pop(event_id)
            held[event_id] = (arrival, first, messages + 1)
    return held


class Doubt:
    """Whether the rows of a stretch alone decide what is held after them, whatever was held at its start.

    An event is surely held, from its creation on, while fewer than ``keep`` others may have been touched since its last
    touch. It is surely not held once ``keep`` others were surely touched since it may last have been touched. Creations
    are sure touches, and so are messages to events surely held; a message to an event that may be held may touch it.
    When all events that may be held are surely held, a replay from any start holds the same ones with the same values.
    """

    def __init__(self, keep: int):
        self.keep, self.clock, self.unsure, self.closed = keep, 0, 0, False
        # By the last touch there may have been: the ``keep`` latest ids with its time and if they are surely held, then
        # those before. ``blurred`` is the latest such time of any id in neither, if that was after the start.
        self.near: OrderedDict[str, tuple[int, bool]] = OrderedDict()
        self.far: OrderedDict[str, int] = OrderedDict()
        self.blurred = 0
        # The ``keep`` ids that were surely touched last.
        self.touched: OrderedDict[str, int] = OrderedDict()

    def ends(self, ids: list[str], created: list[bool]) -> bool:
        """Take up more rows; true as soon as nothing depends on the start any more."""
        near, far = self.near, self.far
        for event_id, is_new in zip(ids, created):
            if is_new:
                sure = True
            elif event_id in near:
                sure = near[event_id][1]
            elif event_id in far or not self.closed:
                sure = False
            else:
                continue
            if self._touch(event_id, sure):
                return True
        return False

    def _touch(self, event_id: str, sure: bool) -> bool:
        near, far, touched = self.near, self.far, self.touched
        self.clock += 1
        far.pop(event_id, None)
        self.unsure += (not sure) - (not near.pop(event_id, (0, True))[1])
        near[event_id] = (self.clock, sure)
        if sure:
            touched.pop(event_id, None)
            touched[event_id] = self.clock
            if len(touched) > self.keep:
                touched.popitem(last=False)
        if len(near) > self.keep:
            oldest, (at, was_sure) = near.popitem(last=False)
            self.unsure -= not was_sure
            far[oldest] = at
            if len(far) > FAR_TIMES * self.keep:
                _, self.blurred = far.popitem(last=False)
        # What may last have been touched before this is not held once ``touched`` is full, and cannot be told from
        # what was never seen until then.
        since = next(iter(touched.values()), self.clock + 1)
        while far and next(iter(far.values())) < since:
            far.popitem(last=False)
        self.closed = len(touched) == self.keep and since > self.blurred
        return self.closed and not far and not self.unsure


def handed_over(batches: Iterator[pa.RecordBatch], keep: int, doubted: bool = True) -> Iterator[pa.RecordBatch]:
    """What each block hands over; rows (block, _at, event_id, arrival, _created, created_arrival, messages) come in order.

    A block starts with what it was given, oldest touch first and with neither in ``_created``. The rows pass by: only
    the events held and one batch are in memory, however long the block. ``sure`` is true if the block would hand over
    the same whatever it was given; without ``doubted`` that is not looked into.
    """
    now, held, touched, doubt = None, OrderedDict(), False, None

    def told():
        columns = list(zip(*held.values())) if held and touched else ((),) * 3
        n = len(columns[0])
        kinds = (pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 3, pa.bool_())
        values = ([now] * n, range(n), list(held)[:n], *columns, [doubted and doubt is None] * n)
        return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], names=[f.split()[0] for f in HELD.split(", ")])

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)] if len(blocks) else []
        for start, stop in zip(starts, starts[1:]):
            if blocks[start] != now:
                yield told()
                now, held, touched, doubt = int(blocks[start]), OrderedDict(), False, Doubt(keep) if doubted else None
            ids, arrivals, created, first, messages = (batch.column(k).slice(start, stop - start).to_pylist() for k in range(2, 7))
            given = created.count(None)
            for row in zip(ids[:given], arrivals, first, messages):
                held[row[0]] = row[1:]
            if given < len(ids):
                touched = True
                replay(ids[given:], arrivals[given:], created[given:], held, keep)
                if doubt and doubt.ends(ids[given:], created[given:]):
                    doubt = None
    yield told()


def _replay_blocks(rows: DataFrame, block: Column, given: DataFrame, keep: int, doubted: bool) -> DataFrame:
    """What each block of ``rows`` hands over, if it starts with what ``given`` has for it."""
    touches = rows.select(block.alias("block"), "_at", "event_id", "arrival", CREATED)
    before = given.select("block", (F.col("rank") - F.lit(keep + 1)).cast("long").alias("_at"), "event_id", F.col("touched_arrival").alias("arrival"), "created_arrival", "messages")
    columns = ["block", "_at", "event_id", "arrival", CREATED, "created_arrival", "messages"]
    both = touches.unionByName(before, allowMissingColumns=True).select(*columns)
    ordered = both.repartition("block").sortWithinPartitions("block", "_at")
    return ordered.mapInArrow(lambda batches: handed_over(batches, keep, doubted), HELD)


def _marks(held: DataFrame) -> dict[int, tuple[tuple[int, int], bool]]:
    """A digest per block of what it hands over, and if that is sure; one row for each block comes to the driver."""
    entry = F.xxhash64("rank", "event_id", "touched_arrival", "created_arrival", "messages")
    found = held.groupBy("block").agg(F.count(F.lit(1)), F.bit_xor(entry), F.bool_and("sure"))
    return {block: ((n, mark), sure) for block, n, mark, sure in found.collect()}


def _cut(made: DataFrame, keep: int) -> int | None:
    """The arrival from which on the tail is taken: a quantile of the creations, so that a stray arrival does not matter."""
    shares = [1 - TAIL_SHARE * 2**step for step in range(int(-math.log2(TAIL_SHARE)))]
    found = made.agg(F.count("arrival").alias("n"), F.percentile_approx("arrival", shares, 10_000).alias("cuts")).first()
    return next((cut for cut, share in zip(found["cuts"] or [], shares) if (1 - share) * found["n"] >= TAIL_TIMES * keep), None)


def _merged(sizes: list[tuple[int, int]], keep: int) -> int:
    """How many low bits of a block's number to leave out, so that a block is long enough to forget its start.

    ``sizes`` has rows and creations of each block. A shuffle of many partitions deals a tail into pieces too short for that.
    """
    rows, made = (sum(column) for column in zip(*sizes))
    bits, pieces = 0, len(sizes)
    while pieces > 1 and made < TAIL_TIMES * keep * pieces and rows < LONG_BLOCK * pieces:
        bits, pieces = bits + 1, -(-pieces // 2)
    return bits


def _replayed(rows: DataFrame, block: Column, numbers: list[int], keep: int, from_nothing: bool) -> DataFrame | None:
    """What is held after the blocks ``numbers``, or none if that depends on what was held before them.

    The first round tells the last block that hands over the same whatever it is given; only what follows it is replayed
    again. With ``from_nothing`` nothing was held before the first block.
    """
    spark = rows.sparkSession
    handed = spark.createDataFrame([], HELD)
    # Lists of blocks are broadcast: no join deals the rows, so only ``_replay_blocks`` decides which lie together.
    follower = F.broadcast(spark.createDataFrame(list(zip(numbers, numbers[1:])) or [(None, None)], "block long, next long"))
    given: dict[int, tuple[int, int] | None] = {}
    marks: dict[int, tuple[tuple[int, int], bool]] = {}
    while True:
        arriving = {number: marks.get(before, (None, False))[0] for before, number in zip([None, *numbers], numbers)}
        stale = [number for number in numbers if number not in given or given[number] != arriving[number]]
        if not stale:
            return handed.where(F.col("block") == numbers[-1]).drop("block", "rank", "sure")
        again = F.broadcast(spark.createDataFrame([(number,) for number in stale], "block long"))
        before = handed.join(follower, "block").select(F.col("next").alias("block"), "rank", "event_id", "touched_arrival", "created_arrival", "messages")
        replayed = _replay_blocks(
            rows.join(F.broadcast(again.withColumnRenamed("block", "_stale")), block == F.col("_stale"), "left_semi"),
            block,
            before.join(again, "block", "left_semi"),
            keep,
            not given,
        )
        handed = written(handed.join(again, "block", "left_anti").unionByName(replayed), "handed-over")
        marks = _marks(handed)
        if not given:
            sure = [place for place, number in enumerate(numbers) if marks.get(number, (None, False))[1]]
            if not sure and not from_nothing:
                return None
            numbers = numbers[sure[-1] if sure else 0 :]
        given |= {number: arriving[number] for number in stale}


def history(events: DataFrame, status: DataFrame, keep: int, created: str = "created_arrival", blocks: int | None = None) -> History:
    """Replay creations and messages in order of arrival.

    ``held`` has ``event_id, touched_arrival, created_arrival, messages`` (those that counted since its creation) of at
    most ``keep`` events. At one arrival, creations come first, then ids in order. Creating an event that is held puts it
    in front with nothing counted. Rows without event id or arrival are left out.

    With ``blocks`` that many are replayed; else blocks too short to forget their start are merged. Messages are computed
    once for the tail, and once more only if what is held depends on what came before the tail.
    """
    made = events.select("event_id", F.col(created).cast("long").alias("arrival"), F.lit(True).alias(CREATED))
    made = made.where("event_id IS NOT NULL AND arrival IS NOT NULL")
    said = status.withColumn("arrival", F.col("arrival").cast("long")).withColumn(CREATED, F.lit(False))
    said = said.where("event_id IS NOT NULL AND arrival IS NOT NULL")
    cut = _cut(made, keep)
    for start in (None,) if cut is None else (cut, None):
        late = F.lit(True) if start is None else F.col("arrival") >= start
        rows = said.where(late).unionByName(made.where(late), allowMissingColumns=True).withColumn("_later", ~F.col(CREATED))
        rows = in_blocks(rows, [], ["arrival", "_later", "event_id"], blocks)
        sizes = rows.groupBy(block_of_place().alias("block")).agg(F.count(F.lit(1)), F.count_if(CREATED)).collect()
        if not sizes:
            break
        bits = 0 if blocks else _merged([(n, created) for _, n, created in sizes], keep)
        block, numbers = F.shiftright(block_of_place(), bits), sorted({number >> bits for number, _, _ in sizes})
        held = None
        if start is None:
            last = int(len(numbers) * LAST_SHARE)
            held = _replayed(rows, block, numbers[-last:], keep, False) if last else None
        if held is None:
            held = _replayed(rows, block, numbers, keep, start is None)
        if held is not None:
            return History(rows.drop("_later"), held)
    return History(rows.drop("_later"), rows.sparkSession.createDataFrame([], HELD).drop("block", "rank", "sure"))
