"""Prefix trie of conversations, rolled up by centroid decomposition of its parent-edge forest.

A node is a distinct sequence of leading turns, named by a chained digest. Its totals over its subtree come from
splitting components: a component's centroid leaves only pieces of half its size; the total of what hangs below the
centroid is added to all nodes on the path from it to the component's top; then the centroid goes, and the pieces are
split in turn. An ancestor and a descendant are parted by exactly one centroid between them, so each value reaches each
ancestor once, in a number of rounds that grows with the logarithm of the nodes, however deep or wide the trie is.

Components beyond a bound are split by joins over all tasks; a component within it goes on being split inside one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed, stored

# Conversations that share a beginning, and the most turns they share (fixed values).
FAMILY, SHARED = 5, 9
# Nodes of a component that one task may split.
PIECE_NODES = 16_384
# Ids of one block of a node's members.
BLOCK_IDS = 4096
ROOT = bytes(16)
TURNS = "conv_id bigint, depth bigint, node binary, parent binary, bytes bigint, ended boolean"
TOTALS = "node binary, n_leaves bigint, saved_tokens bigint"
ENDS = "node binary, ends_sha256 string"


def turns_of(conversations: DataFrame) -> DataFrame:
    """One small row per turn: conv_id, pos (from 0), digest of role and text, bytes of the text.

    Turns are in the order of ``turn``, null first; equal turn numbers by the digest, so that repeated rows are
    repeated turns and the result is defined. Null role or text is empty. Rows without conv_id belong to no
    conversation and are left out.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest", "bytes")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "digest", "bytes")


def shared_turns(conv: Column) -> Column:
    """How many leading turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string")) % SHARED


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation with the leading turns of its family's first one, then its own turns after as many.

    One row per turn, by (part, pos), and a row of part 0 for every conversation, also for one that has no turn left.
    """
    own = stored(turns_of(conversations))
    conv = F.col("conv_id")
    heads = own.where((conv % FAMILY == 0) & (F.col("pos") < SHARED - 1)).select(conv.alias("base"), "pos", "digest", "bytes")
    others = own.where((F.col("pos") == 0) & (conv % FAMILY != 0)).select("conv_id", (conv - conv % FAMILY).alias("base"))
    taken = others.join(heads, "base").where(F.col("pos") < shared_turns(conv)).select("conv_id", F.lit(1).alias("part"), "pos", "digest", "bytes")
    rest = own.where((conv % FAMILY == 0) | (F.col("pos") >= shared_turns(conv))).select("conv_id", F.lit(2).alias("part"), "pos", "digest", "bytes")
    opens = own.where(F.col("pos") == 0).select("conv_id", F.lit(0).alias("part"), "pos", F.lit(b"").alias("digest"), F.lit(0).cast("bigint").alias("bytes"))
    return opens.unionByName(taken).unionByName(rest)


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name the prefixes of sorted turns; a conversation goes on from batch to batch, so only its last row is held."""
    last = None  # conv_id, depth, node, parent, bytes

    def packed(rows: list, ended: list[bool]) -> pa.RecordBatch:
        conv, depth, node, parent, size = zip(*rows) if rows else ((),) * 5
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
        columns = [pa.array(values, kind) for values, kind in zip((conv, depth, node, parent, size), kinds)]
        return pa.record_batch([*columns, pa.array(ended, pa.bool_())], names=["conv_id", "depth", "node", "parent", "bytes", "ended"])

    for batch in batches:
        rows, ended = [], []
        for conv, part, digest, size in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
            if last is not None:
                rows.append(last)
                ended.append(part == 0)
            if part == 0:
                last = (conv, 0, ROOT, None, 0)
            else:
                last = (conv, last[1] + 1, hashlib.blake2b(last[2] + digest, digest_size=16).digest(), last[2], size)
        yield packed(rows, ended)
    if last is not None:
        yield packed([last], [True])


def member_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation and prefix of it: conv_id, depth, node, parent, bytes of the last text, ended."""
    dealt = turns.select("conv_id", "part", "pos", "digest", "bytes").repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return dealt.mapInArrow(chain, TURNS)


def trie(members: DataFrame) -> DataFrame:
    """The nodes: node, parent, depth, bytes, conv_id (smallest member), n_convs, n_children."""
    # Parent, depth and bytes depend on the node alone; as keys they need no aggregate buffers.
    nodes = members.groupBy("node", "parent", "depth", "bytes").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    return nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's sorted blocks of ids; only the state of one digest is held."""
    now, state = None, None
    for batch in batches:
        done = []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if node != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        names, digests = zip(*done) if done else ((), ())
        yield pa.record_batch([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if state is not None:
        yield pa.record_batch([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["node", "ends_sha256"])


def ends_of(members: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes at which conversations end.

    Ids are joined to blocks before they meet, so that a node at which very many equal conversations end brings
    one row per block of ids to the task that digests them.
    """
    blocks = (
        members.where("ended")
        .groupBy("node", F.floor(F.col("conv_id") / BLOCK_IDS).alias("block"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )
    return blocks.repartition("node").sortWithinPartitions("node", "block").select("node", "block", "ids").mapInArrow(digest_ends, ENDS)


def roll_up(parents: list[int], values: list[tuple[int, int]]) -> list[list[int]]:
    """Subtree totals of one component; a parent comes before its children, the top (parent -1) first."""
    totals = [[0, 0] for _ in parents]
    sizes = [0] * len(parents)
    branch = [-1] * len(parents)
    waiting = [list(range(len(parents)))]
    while waiting:
        nodes = waiting.pop()
        top = nodes[0]
        for v in nodes:
            sizes[v], branch[v] = 1, -1
        for v in reversed(nodes):
            if v != top:
                sizes[parents[v]] += sizes[v]
        # Nodes that hold more than half lie on one path, so the last of them is the deepest.
        centroid = next(v for v in reversed(nodes) if 2 * sizes[v] > len(nodes))
        leaves, saved = values[centroid]
        pieces: dict[int, list[int]] = {}
        above = []
        for v in nodes:
            if v == centroid:
                continue
            if v != top and parents[v] == centroid:
                branch[v] = v
            elif v != top:
                branch[v] = branch[parents[v]]
            if branch[v] < 0:
                above.append(v)
            else:
                pieces.setdefault(branch[v], []).append(v)
                leaves += values[v][0]
                saved += values[v][1]
        v = centroid
        while True:
            totals[v][0] += leaves
            totals[v][1] += saved
            if v == top:
                break
            v = parents[v]
        if above:
            waiting.append(above)
        waiting.extend(pieces.values())
    return totals


def split_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of whole components, which come sorted by component and depth; one component is held at a time."""
    now, held = None, []

    def finished() -> list[tuple[bytes, int, int]]:
        at = {row[0]: i for i, row in enumerate(held)}
        totals = roll_up([-1] + [at[row[1]] for row in held[1:]], [(row[2], row[3]) for row in held])
        return [(row[0], row[4] + leaves, row[5] + saved) for row, (leaves, saved) in zip(held, totals)]

    def packed(rows: list) -> pa.RecordBatch:
        node, leaves, saved = zip(*rows) if rows else ((),) * 3
        return pa.record_batch([pa.array(node, pa.binary()), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], names=["node", "n_leaves", "saved_tokens"])

    for batch in batches:
        done = []
        for part, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if part != now:
                if held:
                    done += finished()
                now, held = part, []
            held.append(row)
        yield packed(done)
    if held:
        yield packed(finished())


def node_counts(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``node, size``: the nodes of each node's subtree.

    The nodes of which a conversation is the smallest member are the end of its path, so a member adds to each of its
    prefixes as many nodes as its path has of its own from there on.
    """
    own = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.max("depth").alias("end"))
    return members.join(own, "conv_id").groupBy("node").agg(F.sum(F.col("end") - F.greatest("depth", "first") + 1).alias("size"))


def split_once(large: DataFrame, paths: DataFrame, counts: DataFrame) -> DataFrame:
    """One round over components that are too large: find centroids, add totals along paths, cut."""
    # The deepest node that holds more than half of its component's nodes.
    centroids = (
        large.join(counts, "comp")
        .where(2 * F.col("size") > F.col("n"))
        .groupBy("comp")
        .agg(F.max(F.struct("depth", "node", "conv_id", "size")).alias("c"))
        .select("comp", F.col("c.depth").alias("c_depth"), F.col("c.node").alias("c_node"), F.col("c.conv_id").alias("c_conv"), F.col("c.size").alias("c_size"))
    )
    centroids = checkpointed(centroids)
    # A node lies below the centroid if the path of its smallest member goes through it, higher up.
    below = paths.join(centroids, paths["parent"] == F.col("c_node")).select(F.col("conv_id"), "comp", F.col("node").alias("branch"), "c_depth")
    # The centroid is the lowest node of the path up to the top, which may begin in other components.
    upward = paths.join(centroids, (paths["conv_id"] == F.col("c_conv")) & (paths["depth"] <= F.col("c_depth"))).select(F.col("node"), "comp", (F.col("node") == F.col("c_node")).alias("is_c"), "c_size")
    placed = checkpointed(
        large.join(below, ["conv_id", "comp"], "left")
        .join(upward, ["node", "comp"], "left")
        .withColumn("is_c", F.coalesce("is_c", F.lit(False)))
        .withColumn("branch", F.when(F.col("depth") > F.col("c_depth"), F.col("branch")))
        .drop("c_depth")
    )
    hung = placed.where(F.col("is_c") | F.col("branch").isNotNull()).groupBy("comp").agg(F.sum("leaf").alias("s_leaves"), F.sum("saved").alias("s_saved"))
    on_path = F.col("c_size").isNotNull()
    return placed.join(hung, "comp").select(
        "node",
        "parent",
        "depth",
        "conv_id",
        F.coalesce("branch", "comp").alias("comp"),
        F.when(on_path & ~F.col("is_c"), F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size"),
        "leaf",
        "saved",
        F.when(on_path, F.col("n_leaves") + F.col("s_leaves")).otherwise(F.col("n_leaves")).alias("n_leaves"),
        F.when(on_path, F.col("saved_tokens") + F.col("s_saved")).otherwise(F.col("saved_tokens")).alias("saved_tokens"),
        F.col("is_c").alias("done"),
    )


def subtree_totals(nodes: DataFrame, members: DataFrame, piece_nodes: int = PIECE_NODES) -> DataFrame:
    """``node, n_leaves, saved_tokens``: childless nodes, and saved tokens, of each node's subtree."""
    zero = F.lit(0).cast("bigint")
    now = nodes.join(node_counts(nodes, members), "node").select(
        "node",
        "parent",
        "depth",
        "conv_id",
        F.lit(ROOT).alias("comp"),
        "size",
        (F.col("n_children") == 0).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        zero.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.lit(False).alias("done"),
    )
    # Of equal beginnings, only the paths that lead to a node as its smallest member are needed below.
    paths = stored(members.join(nodes.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "depth", "node", "parent"))
    finished = []
    while True:
        now = checkpointed(now)
        finished.append(now.where("done").select("node", "n_leaves", "saved_tokens"))
        counts = checkpointed(now.where("NOT done").groupBy("comp").agg(F.count("*").alias("n")).where(F.col("n") > piece_nodes))
        small = now.where("NOT done").join(counts, "comp", "left_anti")
        dealt = small.select("comp", "node", "parent", "leaf", "saved", "n_leaves", "saved_tokens", "depth").repartition("comp").sortWithinPartitions("comp", "depth")
        finished.append(dealt.drop("depth").mapInArrow(split_inside, TOTALS))
        if counts.isEmpty():
            return reduce(DataFrame.unionByName, finished)
        now = split_once(now.where("NOT done").join(counts, "comp", "left_semi"), paths, counts)


def rolled_up(members: DataFrame, piece_nodes: int = PIECE_NODES) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    An empty table has no conversation, hence no node. Extra columns of the conversations are not read.
    """
    members = stored(members)
    nodes = stored(trie(members))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(subtree_totals(nodes, members, piece_nodes), "node")
        .join(ends_of(members), "node", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
