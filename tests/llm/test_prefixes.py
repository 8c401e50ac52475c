"""The prefix trie against a plain version, splitting over tasks and inside one, odd conversations."""

import hashlib
import random
import zlib

import pytest

from eventlake.llm import prefixes

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    cut = lambda c: c - int(c % 5 if c >= 0 else -(-c % 5))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(cut(c), [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, convs in members.items():
        value = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] = saved.get(node[:d], 0) + value
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
    return sorted(
        (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(convs),
            children.get(node, 0),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if built[c] == node).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def run(spark, rows, pieces):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "text AS node", "text AS depth")
    got = prefixes.rolled_up(prefixes.member_rows(prefixes.rebuilt(frame)), pieces)
    return sorted(tuple(r) for r in got.collect())


def conversations(seed, n=60, deepest=14):
    draw = random.Random(seed)
    rows = []
    for conv in range(-7, n):
        if draw.random() < 0.1:
            continue
        rows += [(conv, turn, draw.choice(["user", "assistant", None]), draw.choice(["a", "bé", None, ""])) for turn in range(draw.randrange(1, deepest))]
    return rows + [(3 * 10**9, None, "user", "x"), (3 * 10**9, 0, "user", "y"), (None, 0, "user", "z")]


@pytest.mark.parametrize("seed, pieces", [(0, 16_384), (1, 7), (2, 1)])
def test_equal_to_the_plain_version(spark, seed, pieces):
    rows = conversations(seed)
    assert run(spark, rows, pieces) == plain(rows)


def test_a_deep_conversation_and_a_wide_trie(spark):
    deep = [(0, t, "user", f"t{t}") for t in range(700)] + [(5, t, "user", f"t{t}") for t in range(300)]
    wide = [(1000 + 5 * i, 0, "user", f"only {i}") for i in range(300)]
    copies = [(5000 + 5 * i, t, "user", "same") for i in range(300) for t in range(3)]
    rows = deep + wide + copies
    assert run(spark, rows, 64) == plain(rows)


def test_roll_up_inside_a_task():
    draw = random.Random(5)
    for size in (1, 2, 3, 50, 400):
        parents = [-1] + [draw.randrange(max(0, v - draw.choice([1, 2, v])), v) for v in range(1, size)]
        values = [(draw.randrange(3), draw.randrange(100)) for _ in range(size)]
        want = [list(v) for v in values]
        for v in range(size - 1, 0, -1):
            want[parents[v]][0] += want[v][0]
            want[parents[v]][1] += want[v][1]
        assert prefixes.roll_up(parents, values) == want


def test_nobody_speaks(spark):
    assert run(spark, [], 5) == []
    assert run(spark, [(None, None, None, None)], 5) == []


def test_repeated_rows_are_repeated_turns(spark):
    rows = [(10, 0, "user", "a"), (10, 0, "user", "a"), (10, None, None, None)]
    assert run(spark, rows, 5) == plain(rows)


def test_an_order_of_ties_is_the_same_for_both_ends(spark):
    first = run(spark, [(10, 0, "user", "a"), (10, 0, "user", "b")], 5)
    assert first == run(spark, [(10, 0, "user", "b"), (10, 0, "user", "a")], 5)


def test_members_in_many_blocks(spark):
    rows = [(20_000 * i, 0, "user", "same") for i in range(-3, 9)] + [(20_000 * i + 5, 0, "user", "same") for i in range(9)]
    assert run(spark, rows, 5) == plain(rows)
