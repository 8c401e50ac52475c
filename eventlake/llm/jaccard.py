"""Exact n-gram Jaccard join with signature trees.

A document is its set of distinct word shingles. Documents of equal sets form a class, and only one of each class is
compared. Classes meet in shards: a set is dealt into so many parts (by token hash) that two sets similar enough must
have an equal part that is not empty, and each part's digest is a shard. This loses no pair. In a shard, a signature
tree joins the sets: nodes hold the OR of their sets' token bitmaps and the range of their sizes, and a traversal of
the tree against itself drops pairs of nodes whose largest possible overlap is too small. Leaf pairs are compared
exactly, unless they are known to be connected.

Two rounds keep large groups of near copies cheap. The first uses a few parts of each set and connects nearly all of
them; the second uses all parts, and only what meets there of different components. Similar sets have many equal parts, so
a set leaves out its most crowded shards, as many as it can without losing a pair: documents that merely share a common
passage meet in crowded shards only. Components that meet often enough to hold similar sets are put together to families,
so that a text is sent to one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed, slices, stored, texts_of
from eventlake.llm.components import components

# Bytes of A-Z to lower case; the white space of the contract is what bytes.split() splits at.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Each size band is about this much wider than the one before.
BAND_GROWTH = 1.5
# Parts beyond the largest number of differences: as many parts of two similar sets are equal at least. Empty parts
# are sent by sets that have more than EMPTY of them. Both grow with the differences a band allows, by one for each
# SPARE_STEP or EMPTY_STEP of them, so similar sets have at least SPARE - EMPTY keys in common in any band.
SPARE, EMPTY = 5, 2
SPARE_STEP, EMPTY_STEP = 6, 24
# Shards, other than crowded ones that were left out, in which similar sets meet at least.
MEET = SPARE - EMPTY
# Parts of each set in the first round.
FIRST_PARTS = 4
# Sets of a shard that one task joins; larger shards are cut into blocks.
SHARD_ROWS = 1000
# Sets of a larger shard, about, that are compared with all of it in the first round.
PIVOTS = 16
# Members of a shard that are paired by component in the second round, at most (PAIRED - 1) / 2 pairs a member; the
# components of larger shards are tied to the least one, a row each.
PAIRED = 8
# Rows of which a join side may be broadcast (two or three numbers each); larger sides are shuffled.
BROADCAST_ROWS = 1_000_000
FANOUT = 8
BITMAP_WORDS = 16
SETS = "doc_id bigint, n bigint, hi bigint, lo bigint, first_keys array<bigint>, keys array<bigint>, next_keys array<bigint>, spared int, next_spared int"
NONE = -(1 << 63)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """64-bit hashes of words, remembered for the words met lately."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > 300_000:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(text: str, width: int, words: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; fewer words than a shingle are one together."""
    found = words.hashes(text.encode("utf-8", "surrogatepass").translate(LOWER).split())
    if not len(found):
        return found
    size = min(width, len(found))
    out = np.full(len(found) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + found[k : len(found) - size + 1 + k])
    return np.unique(out)


def bands(percent: int, top: int) -> list[int]:
    """First sizes of the bands, up to beyond ``top``. A similar set lies in the same or in a neighbouring band."""
    if not 75 <= percent <= 100:
        raise ValueError("the similarity must be between 75 and 100 percent")
    starts = [1]
    while starts[-1] <= top:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_GROWTH)))
    return starts


def parts_of(last: int, percent: int) -> tuple[int, int]:
    """Into how many parts the sets of a band are dealt, and how many empty ones of a set are not sent."""
    most = (100 - percent) * 2 * last // (100 + percent)
    return most + SPARE + most // SPARE_STEP, EMPTY + most // EMPTY_STEP


def spared(size: int, last: int, percent: int) -> int:
    """How many shards of a band a set may leave out, if all sets leave out the last ones in one order of all shards.

    Any similar set of the band shares at least ``spared + MEET`` keys with it; the first ``MEET`` of these are kept by both.
    """
    parts, empty = parts_of(last, percent)
    other = min(last, size * 100 // percent)
    return parts - (100 - percent) * (size + other) // (100 + percent) - empty - MEET


def part_keys(tokens: np.ndarray, band: int, last: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the parts of a set for a band with sizes up to ``last``, and the numbers of these parts.

    Sets of a and b tokens with similarity p differ in at most (1 - p)(a + b) / (1 + p) tokens, so at least
    ``SPARE`` of the parts have no difference.
    """
    parts, empty = parts_of(last, percent)
    spot = ((tokens >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(spot, kind="stable")
    filled, begins = np.unique(spot[order], return_index=True)
    sums = np.add.reduceat(mixed(tokens[order]), begins)
    if parts - len(filled) > empty:
        every = np.zeros(parts, np.uint64)
        every[filled] = sums
        filled, sums = np.arange(parts), every
    return mixed(mixed(sums + np.uint64(band)) + filled.astype(np.uint64)), filled


def bands_of(size: int, starts: list[int], percent: int) -> list[int]:
    """The set's own band and, near its upper end, the next one."""
    band = int(np.searchsorted(starts, size, side="right")) - 1
    return [b for b in (band, band + 1) if b == band or 100 * size >= percent * starts[b]]


def keys_of(tokens: np.ndarray, starts: list[int], percent: int) -> tuple[np.ndarray, ...]:
    """Keys of the first round, and all keys for the set's own band and for the next one (none if it is not in it)."""
    first, every = [], []
    for b in bands_of(len(tokens), starts, percent):
        keys, spots = part_keys(tokens, b, starts[b + 1] - 1, percent)
        first.append(keys[spots < FIRST_PARTS])
        every.append(keys)
    return np.concatenate(first), every[0], every[1] if len(every) > 1 else np.empty(0, np.uint64)


def sets_of(documents: DataFrame, width: int, percent: int) -> DataFrame:
    def run(batches):
        words, starts = Words(), bands(percent, 1 << 20)
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                tokens = shingles(text, width, words)
                if not len(tokens):
                    rows.append((doc_id, 0, 0, 0, [], [], [], 0, 0))
                    continue
                if len(tokens) >= starts[-2]:
                    starts = bands(percent, 2 * len(tokens))
                keys = [k.view(np.int64) for k in keys_of(tokens, starts, percent)]
                spare = [spared(len(tokens), starts[b + 1] - 1, percent) for b in bands_of(len(tokens), starts, percent)]
                hi, lo = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), "<i8").tolist()
                rows.append((doc_id, len(tokens), hi, lo, *keys, spare[0], spare[-1]))
            columns = list(zip(*rows))
            kinds = (*[pa.int64()] * 4, *[pa.list_(pa.int64())] * 3, pa.int32(), pa.int32())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in SETS.split(", ")])

    return texts_of(documents).mapInArrow(run, SETS)


class Tree:
    """Signature tree over sets: level 0 are the sets, each node above covers ``FANOUT`` of the level below."""

    def __init__(self, sets: list[np.ndarray]):
        # Sets with the same least tokens are likely alike and so come to lie together.
        self.order = sorted(range(len(sets)), key=lambda i: (sets[i][0], len(sets[i])))
        self.sets = [sets[i] for i in self.order]
        marks = np.zeros((len(sets), BITMAP_WORDS), np.uint64)
        for k, tokens in enumerate(self.sets):
            bit = (tokens >> np.uint64(7)) % np.uint64(64 * BITMAP_WORDS)
            np.bitwise_or.at(marks[k], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        sizes = np.array([len(s) for s in self.sets])
        # Tokens that share a bit with another one of their set.
        slack = sizes - np.bitwise_count(marks).sum(axis=1)
        self.levels = [(marks, sizes, sizes, slack)]
        while len(self.levels[-1][0]) > 1:
            marks, least, most, slack = self.levels[-1]
            at = np.arange(0, len(marks), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(marks, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at), np.maximum.reduceat(slack, at)))

    def possible(self, level: int, xs: np.ndarray, ys: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of nodes can hold a similar pair of sets, by sizes and by the largest possible overlap."""
        marks, least, most, slack = self.levels[level]
        near = (100 * most[xs] >= percent * least[ys]) & (100 * most[ys] >= percent * least[xs])
        common = np.bitwise_count(marks[xs] & marks[ys]).sum(axis=1)
        overlap = np.minimum(np.minimum(most[xs], most[ys]), common + np.minimum(slack[xs], slack[ys]))
        return near & (overlap * (100 + percent) >= percent * (least[xs] + least[ys]))

    def pairs(self, percent: int) -> Iterator[tuple[int, int]]:
        """Pairs of leaves that the traversal of the tree against itself cannot rule out."""
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        while stack:
            level, x, y = stack.pop()
            if level == 0:
                if x < y:
                    yield x, y
                continue
            size = len(self.levels[level - 1][0])
            a = np.arange(x * FANOUT, min((x + 1) * FANOUT, size))
            b = np.arange(y * FANOUT, min((y + 1) * FANOUT, size))
            xs, ys = np.repeat(a, len(b)), np.tile(b, len(a))
            keep = (xs < ys) if level == 1 else (xs <= ys)
            xs, ys = xs[keep], ys[keep]
            fits = self.possible(level - 1, xs, ys, percent)
            stack.extend((level - 1, i, j) for i, j in zip(xs[fits].tolist()[::-1], ys[fits].tolist()[::-1]))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def join_shard(ids: list[int], groups: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges that connect similar sets of a shard which were not connected; ``groups`` are their components so far."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    tree = Tree(sets)
    member = [groups[i] for i in tree.order]
    edges = []
    for x, y in tree.pairs(percent):
        a, b = root(member[x]), root(member[y])
        if a != b and similar(tree.sets[x], tree.sets[y], percent):
            parent[max(a, b)] = min(a, b)
            edges.append((ids[tree.order[x]], ids[tree.order[y]]))
    return edges


def join_shards(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by shard; columns shard (key, i, j), id, group, text."""
    words = Words()
    now, ids, groups, sets, edges = None, [], [], [], []
    for batch in batches:
        for key, i, j, rep, group, text in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if (key, i, j) != now:
                if len(ids) > 1:
                    edges += join_shard(ids, groups, sets, percent)
                now, ids, groups, sets = (key, i, j), [], [], []
            ids.append(rep)
            groups.append(group)
            sets.append(shingles(text, width, words))
        if len(edges) > 10_000:
            yield pa.record_batch([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])
            edges = []
    if len(ids) > 1:
        edges += join_shard(ids, groups, sets, percent)
    yield pa.record_batch([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])


def bounded(side: DataFrame) -> DataFrame:
    """A written join side, broadcast if it has few enough rows and shuffled otherwise."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def first_places(members: DataFrame, shards: DataFrame) -> DataFrame:
    """Where members are compared in the first round: in one block of their shard, and some, the pivots, in all.

    Pivots tie the blocks together, so a large shard costs work in proportion to its size.
    """
    rows = members.join(shards, "key").withColumn("blocks", F.ceil(F.col("n") / SHARD_ROWS).cast("int"))
    own = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("blocks")).cast("int")
    pivot = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("rep", F.lit(3)), F.col("n")) < PIVOTS)
    places = F.when(pivot, F.expr("sequence(0, blocks - 1)")).otherwise(F.array(own))
    return rows.select("key", F.explode(places).alias("i"), F.lit(0).alias("j"), "rep", "comp")


def second_places(members: DataFrame, shards: DataFrame) -> DataFrame:
    """Where members are compared in the second round: every two of different components meet.

    In a large shard the members of its largest component need not meet each other. They are dealt into blocks, the
    others too, and each block of the others meets all blocks.
    """
    half = SHARD_ROWS // 2 + 1
    large = shards.where(F.col("n") > SHARD_ROWS)
    counts = members.join(large.select("key"), "key").groupBy("key", "comp").agg(F.count("*").alias("c"))
    # The largest component: most members, and of those the least name.
    most = counts.groupBy("key").agg(F.min(F.struct((-F.col("c")).alias("c"), "comp")).alias("top"))
    most = most.select("key", F.col("top.comp").alias("largest"), (-F.col("top.c")).alias("inside"))
    rows = members.join(shards, "key").join(most, "key", "left")
    rows = rows.withColumns(
        {
            "wide": F.ceil(F.col("inside") / half).cast("int"),
            "others": F.ceil((F.col("n") - F.col("inside")) / half).cast("int"),
            "hash": F.xxhash64("rep", F.lit(2)),
        }
    )
    small = F.expr("array(struct(0 AS i, 0 AS j))")
    inner = F.expr("transform(sequence(0, others - 1), u -> struct(u AS i, CAST(pmod(hash, wide) AS int) AS j))")
    outer = F.expr(
        """concat(
          transform(sequence(0, wide - 1), c -> struct(CAST(pmod(hash, others) AS int) AS i, c AS j)),
          transform(filter(sequence(0, others - 1), u -> u <> pmod(hash, others)),
            u -> struct(CAST(least(u, pmod(hash, others)) AS int) AS i, CAST(wide + greatest(u, pmod(hash, others)) AS int) AS j)))"""
    )
    places = F.when(F.col("largest").isNull(), small).when(F.col("comp") == F.col("largest"), inner).otherwise(outer)
    return rows.select("key", F.explode(places).alias("at"), "rep", "comp").select("key", "at.i", "at.j", "rep", "comp")


def shard_edges(documents: DataFrame, members: DataFrame, places: Callable, width: int, percent: int) -> DataFrame:
    """Edges found in the shards of ``members`` (key, rep, comp), each compared where ``places`` puts it."""
    # Shards of the same sets are one; sums of two hashes tell sets apart.
    marks = [F.sum(F.xxhash64("rep", F.lit(seed)).cast("decimal(20,0)")).alias(f"mark{seed}") for seed in (0, 1)]
    sized = members.groupBy("key").agg(F.count("*").alias("n"), *marks)
    once = checkpointed(sized.groupBy("n", "mark0", "mark1").agg(F.min("key").alias("key")).select("key", "n"))
    rows = checkpointed(places(members, once))
    texts = texts_of(documents).withColumn("rep", F.coalesce(F.col("doc_id"), F.lit(NONE))).select("rep", "text")
    full = texts.join(bounded(rows), "rep").select("key", "i", "j", "rep", "comp", "text")
    full = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    return full.mapInArrow(lambda batches: join_shards(batches, width, percent), "a bigint, b bigint")


MET = "key bigint, a bigint, b bigint, n bigint"


def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What meets in the shards of a task; rows (key, rep, comp) come ordered by key.

    From a shard of up to ``PAIRED`` members the pairs of its components (no key; n: in how many shards of a batch),
    from a larger one its members (a: rep, b: comp, n: 0). A shard can span batches, so the last one of a batch
    waits; a large one passes through.
    """
    rest, large = np.empty((0, 3), np.int64), None

    def told(columns):
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in MET.split(", ")])

    def of(rows, final):
        nonlocal rest, large
        begins = np.flatnonzero(np.r_[True, np.diff(rows[:, 0]) != 0]) if len(rows) else np.empty(0, np.int64)
        sizes = np.diff(np.append(begins, len(rows)))
        keep = 0
        if not final and len(sizes) and sizes[-1] <= PAIRED and rows[-1, 0] != large:
            keep = sizes[-1]
            begins, sizes = begins[:-1], sizes[:-1]
        done, rest = rows[: len(rows) - keep], rows[len(rows) - keep :]
        wide = (sizes > PAIRED) | (done[begins, 0] == large if large is not None else False)
        members = done[np.repeat(wide, sizes)]
        if len(sizes) and not keep:
            large = int(done[-1, 0]) if wide[-1] else None
        elif keep:
            large = None
        if len(members):
            yield told((members[:, 0], members[:, 1], members[:, 2], np.zeros(len(members), np.int64)))
        pairs = []
        for start, size in zip(begins[~wide & (sizes > 1)], sizes[~wide & (sizes > 1)]):
            met = np.unique(done[start : start + size, 2])
            if len(met) > 1:
                x, y = np.triu_indices(len(met), 1)
                pairs.append(np.stack([met[x], met[y]], axis=1))
        if pairs:
            met = np.concatenate(pairs)
            met = met[np.lexsort((met[:, 1], met[:, 0]))]
            first = np.flatnonzero(np.r_[True, (np.diff(met, axis=0) != 0).any(axis=1)])
            found, counts = met[first], np.diff(np.append(first, len(met)))
            yield told((np.zeros(len(found), np.int64), found[:, 0], found[:, 1], counts))

    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
        yield from of(np.concatenate([rest, rows]), False)
    yield from of(rest, True)


def telling(sets: DataFrame) -> DataFrame:
    """``key, rep, comp``: the shards of each set in which components meet, without the crowded ones it may leave out.

    ``sets`` holds the keys of each ``rep`` and its ``comp``. A shard is as crowded as it has members; ties go by key, so all
    sets follow one order. Rows of shards with a single component, most of all, go no further than to their shard.
    """
    upper = F.size("keys")
    rows = sets.select("rep", "comp", "spared", "next_spared", upper.alias("own"), F.posexplode(F.concat("keys", "next_keys")).alias("at", "key"))
    beyond = F.col("at") >= F.col("own")
    # The band (of two) and how many shards of it may go, in one number.
    allowed = F.when(beyond, 2 * F.col("next_spared") + 1).otherwise(2 * F.col("spared")).alias("allowed")
    rows = rows.select("key", "rep", "comp", allowed)
    shard = Window.partitionBy("key")
    rows = rows.withColumns({"members": F.count("*").over(shard), "low": F.min("comp").over(shard), "high": F.max("comp").over(shard)})
    rows = rows.where("low < high").select("key", "rep", "comp", "allowed", "members")
    crowded = Window.partitionBy("rep", F.col("allowed") % 2).orderBy(F.desc("members"), F.desc("key"))
    rows = rows.withColumn("place", F.row_number().over(crowded))
    return rows.where(F.col("place") > F.floor(F.col("allowed") / 2)).select("key", "rep", "comp")


def families(comps: DataFrame, met: DataFrame) -> DataFrame:
    """Members (key, rep, comp) to be compared in the second round.

    Components that meet in enough shards, or in a large one, make a family, which is one shard. Of larger families, each
    component is a shard with its partners, and large shards stay as they are. Similar sets meet in ``MEET`` shards, so
    they do in a large one or in so many others. Rows are in proportion to those of ``met``.
    """
    rows = comps.select(F.col("place").alias("rep"), "comp")
    pairs = met.where("n > 0").groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= MEET).select("a", "b")
    pairs = checkpointed(pairs)
    large = met.where("n = 0").select("key", F.col("a").alias("rep"), F.col("b").alias("comp"))
    ties = large.select("key", "comp").distinct().withColumnRenamed("comp", "a").join(large.groupBy("key").agg(F.min("comp").alias("b")), "key")
    found = checkpointed(components(pairs.union(ties.where("a > b").select("a", "b"))))
    sized = rows.join(found, rows["comp"] == found["node"]).select("rep", "comp", F.col("component").alias("family"))
    sizes = sized.groupBy("family").agg(F.count("*").alias("n"))
    small = sizes.where(F.col("n") <= SHARD_ROWS).select("family")
    out = sized.join(small, "family").select(F.col("family").alias("key"), "rep", "comp")
    wide = found.join(sizes.where(F.col("n") > SHARD_ROWS), found["component"] == sizes["family"]).select("node")
    stars = pairs.join(wide, pairs["a"] == wide["node"]).select(F.col("a").alias("key"), F.explode(F.array("a", "b")).alias("comp")).distinct()
    out = out.union(stars.join(rows, "comp").select("key", "rep", "comp"))
    # The components of a large shard are of one family; a single one is of none by that shard.
    several = large.join(wide, large["comp"] == wide["node"]).select("key", "rep", "comp")
    both = several.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    return out.union(several.join(both, "key", "left_semi").select("key", "rep", "comp"))


def linked(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document.

    Two documents link when the Jaccard similarity of their shingle sets is at least ``percent`` / 100. The component
    is the smallest id reachable by links, itself included. Null and empty texts and texts without words have no
    shingles and link with nothing. Repeated rows give a row each; rows of one id with different texts are linked as one
    document. A null id counts as smaller than all; its component is null.
    """
    sets = checkpointed(sets_of(documents, width, percent).withColumn("place", F.coalesce(F.col("doc_id"), F.lit(NONE))))
    # One document stands for its class; all members have the same keys, which are stored once, with the sets.
    classes = checkpointed(sets.where("n > 0").groupBy("hi", "lo").agg(F.min("place").alias("place")))
    # First round: a few parts of every set.
    own = sets.join(bounded(classes), ["hi", "lo", "place"])
    first = own.select(F.col("place").alias("rep"), F.col("place").alias("comp"), F.explode("first_keys").alias("key"))
    several = checkpointed(first.groupBy("key").count().where("count > 1").select("key"))
    edges = checkpointed(shard_edges(documents, checkpointed(first.join(bounded(several), "key")), first_places, width, percent))
    known = components(edges)
    # Second round: all parts, where components meet.
    comps = checkpointed(classes.join(known, classes["place"] == known["node"], "left").select("hi", "lo", "place", F.coalesce("component", "place").alias("comp")))
    own = sets.join(bounded(comps), ["hi", "lo", "place"])
    every = telling(own.withColumnRenamed("place", "rep"))
    met = every.repartition("key").sortWithinPartitions("key").mapInArrow(meetings, MET)
    more = shard_edges(documents, checkpointed(families(comps, stored(met))), second_places, width, percent)
    final = components(edges.union(more))
    named = classes.join(final, classes["place"] == final["node"], "left").select("hi", "lo", F.coalesce("component", "place").alias("component"))
    out = sets.select("doc_id", "n", "hi", "lo").join(named, ["hi", "lo"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.nullif(F.col("component"), F.lit(NONE)))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def standing_id(doc_id: Column, text: Column) -> Column:
    """The id of a row, and for a null id one of its text's own, below all ids that are in use.

    So rows without id are not taken for one document: only equal texts among them share a number.
    """
    own = F.lit(NONE + 1) + F.shiftrightunsigned(F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))), 4)
    return F.coalesce(doc_id.cast("bigint"), own)


def one_of_each(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without all but the smallest of each component; all columns as they were.

    A null id counts as smaller than all; rows without id are documents of their own, apart from equal texts. Rows that
    repeat an id are one document, so they stay or go together.
    """
    standing = standing_id(documents["doc_id"], documents["text"])
    named = linked(documents.select(standing.alias("doc_id"), "text"), width, percent)
    gone = checkpointed(named.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct())
    return documents.join(gone, standing == gone["doc_id"], "left_anti")
