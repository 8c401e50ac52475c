"""Jaccard join, components, substring chunks and fingerprints, against plain versions."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from eventlake.llm import components, fingerprint, jaccard, substring
from eventlake.llm.common import text_bytes
from tests.llm.frames import no_documents, odd_documents, rows, texts


def plain_components(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = plain_components([e for e in edges if e[0] != e[1]])
    assert got == want
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- Jaccard ---------------------------------------------------------------------------------------------------


def shingle_set(text, width):
    words = [w.decode() for w in (text or "").encode().translate(jaccard.LOWER).split()]
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def plain_join(rows, width, percent):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    edges = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    named = plain_components(edges)
    return sorted((i, len(s), named.get(i, i)) for i, s in sets)


def near_copies(rng, n, words, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(500)}"
        if rng.random() < 0.3:
            copy.insert(rng.randrange(len(copy)), "x")
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 75)])
def test_join_equals_plain_version(spark, monkeypatch, width, percent):
    monkeypatch.setattr(jaccard, "SHARD_ROWS", 7)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "PAIRED", 3)
    rng = random.Random(width)
    found = []
    for words, edits in ((3, 1), (9, 1), (11, 1), (12, 2), (40, 2), (80, 6), (200, 9), (350, 12)):
        found += near_copies(rng, 14, words, edits)
    found += ["A b  c", "a B c", "a b", "a b", "a", "", None, "one two three"]
    rng.shuffle(found)
    rows = list(enumerate(found))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in jaccard.linked(frame, width, percent).collect()) == plain_join(rows, width, percent)


def test_similar_sets_share_a_key():
    """Random pairs at and around the threshold: whenever they are similar they have a key in common."""
    rng = np.random.default_rng(3)
    checked = 0
    for _ in range(1500):
        percent = int(rng.choice([75, 80, 90, 95]))
        size = int(rng.integers(1, 120))
        base = rng.integers(0, 1 << 63, size + 40).astype(np.uint64)
        drop, add = rng.integers(0, size // 6 + 2, 2)
        a, b = np.unique(base[:size]), np.unique(np.concatenate([base[drop:size], base[size : size + add]]))
        if len(b) and jaccard.similar(a, b, percent):
            starts = jaccard.bands(percent, 4096)
            keys = [np.concatenate(jaccard.keys_of(x, starts, percent)) for x in (a, b)]
            assert np.intersect1d(*keys).size
            checked += 1
    assert checked > 300


def test_similar_sets_keep_shards_in_common():
    """Whatever the order of shards: similar sets that leave out their last ones still meet in MEET shards of a band."""
    rng = np.random.default_rng(9)
    checked = 0
    for _ in range(1500):
        percent = int(rng.choice([75, 80, 90, 95]))
        size = int(rng.integers(1, 500))
        base = rng.integers(0, 1 << 63, 2 * size + 9).astype(np.uint64)
        drop, add = rng.integers(0, size // 6 + 2, 2)
        a, b = np.unique(base[:size]), np.unique(np.concatenate([base[drop:size], base[size : size + add]]))
        if not len(b) or not jaccard.similar(a, b, percent):
            continue
        starts, seed = jaccard.bands(percent, 4096), np.uint64(rng.integers(1 << 60))
        kept = []
        for x in (a, b):
            own = {}
            for band, keys in zip(jaccard.bands_of(len(x), starts, percent), jaccard.keys_of(x, starts, percent)[1:]):
                leave = jaccard.spared(len(x), starts[band + 1] - 1, percent)
                assert leave >= 0
                # The shards both sets are in count as the most crowded ones, which is the worst case.
                both = np.isin(keys, np.concatenate(jaccard.keys_of(b if x is a else a, starts, percent)[1:]))
                order = np.lexsort((jaccard.mixed(keys ^ seed), ~both))
                own[band] = set(keys[order][leave:].tolist())
            kept.append(own)
        assert max(len(kept[0].get(band, set()) & kept[1].get(band, set())) for band in kept[0]) >= jaccard.MEET
        checked += 1
    assert checked > 300


def test_tree_yields_every_similar_pair():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 1 << 62, int(rng.integers(5, 300))).astype(np.uint64)
        for _ in range(rng.integers(1, 5)):
            sets.append(np.unique(np.concatenate([base[rng.integers(0, 3) :], rng.integers(0, 1 << 62, rng.integers(0, 4)).astype(np.uint64)])))
    tree = jaccard.Tree(sets)
    offered = set(tree.pairs(90))
    real = {(x, y) for x in range(len(sets)) for y in range(x + 1, len(sets)) if jaccard.similar(tree.sets[x], tree.sets[y], 90)}
    assert real <= offered and len(offered) < len(sets) * (len(sets) - 1) / 8


def test_meetings_do_not_depend_on_batches(monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED", 5)
    rng = np.random.default_rng(2)
    sizes = rng.choice([1, 2, 3, 5, 6, 14], 60)
    rows = np.stack([np.repeat(np.sort(rng.choice(10**6, 60, replace=False)), sizes), rng.integers(0, 99, sizes.sum()), rng.integers(0, 4, sizes.sum())], axis=1)
    want_pairs, want_members = {}, []
    for key in np.unique(rows[:, 0]):
        own = rows[rows[:, 0] == key]
        if len(own) > 5:
            want_members += [tuple(r) for r in own.tolist()]
            continue
        comps = sorted(set(own[:, 2].tolist()))
        for pair in itertools.combinations(comps, 2):
            want_pairs[pair] = want_pairs.get(pair, 0) + 1
    for cut in (1, 3, 7, 1000):
        batches = [pa.record_batch([pa.array(c) for c in rows[i : i + cut].T], names=["key", "rep", "comp"]) for i in range(0, len(rows), cut)]
        pairs, members = {}, []
        for key, a, b, n in (r for out in jaccard.meetings(iter(batches)) for r in zip(*(out.column(k).to_pylist() for k in range(4)))):
            if n:
                pairs[a, b] = pairs.get((a, b), 0) + n
            else:
                members.append((key, a, b))
        assert pairs == want_pairs and members == want_members


def test_meetings_grow_with_the_members_not_with_their_square():
    """Shards in which everyone is of another component give at most a few rows a member, whatever their size."""
    for size in (2, 8, 9, 50, 250):
        rows = [(key, rep, rep) for key in range(3) for rep in range(size * key, size * key + size)]
        batch = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=["key", "rep", "comp"])
        assert 0 < sum(out.num_rows for out in jaccard.meetings(iter([batch]))) <= 4 * len(rows)


def test_families_hold_all_that_meet(spark, monkeypatch):
    """Components that meet in a large shard, or often enough in small ones, stay together in families of any size."""
    monkeypatch.setattr(jaccard, "SHARD_ROWS", 12)
    large = {100: range(0, 10), 101: range(9, 20), 102: range(30, 40), 103: [50] * 9}
    met = [(key, rep, comp, 0) for key, comps in large.items() for rep, comp in enumerate(comps, 0 if key == 103 else comps[0])]
    met += [(0, 41, 42, jaccard.MEET - 1), (0, 41, 42, 1), (0, 43, 44, jaccard.MEET - 1), (0, 5, 45, jaccard.MEET)]
    comps = [(i, i) for i in range(50)] + [(50, 50), (51, 50)]
    got = jaccard.families(spark.createDataFrame(comps, "place bigint, comp bigint"), spark.createDataFrame(met, jaccard.MET)).collect()
    shards = {}
    for row in got:
        shards.setdefault(row.key, set()).add(row.comp)
    together = {(a, b) for members in shards.values() for a, b in itertools.combinations(sorted(members), 2)}
    want = {pair for comps in large.values() for pair in itertools.combinations(sorted(set(comps)), 2)} | {(41, 42), (5, 45)}
    assert want <= together and (43, 44) not in together
    # The two that make one wide family stay shards; the others are sent once.
    assert not any({0, 19} <= members for members in shards.values())
    assert all(len([r for r in got if r.rep == rep]) == 1 for rep in (30, 39, 41, 42))


def test_join_odd_inputs(spark):
    got = jaccard.linked(odd_documents(spark)).collect()
    assert len(got) == 10
    assert {r.component_id for r in got if r.doc_id == 1} == {1}
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id in (2, 3)} == {(0, 2), (0, 3)}
    assert jaccard.linked(no_documents(spark)).count() == 0
    kept = jaccard.one_of_each(odd_documents(spark))
    assert kept.count() == 10 and kept.columns == odd_documents(spark).columns


# -- substrings ------------------------------------------------------------------------------------------------


def test_chunks_rebuild_texts_and_do_not_depend_on_the_slice():
    rng = random.Random(4)
    given = ["", "short", "é" * 700, "a" * 5000, *("".join(rng.choices("abcdefgh éü", k=rng.randint(1, 3000))) for _ in range(30))]
    batch = pa.record_batch([pa.array(range(len(given))), pa.array(given)], names=["doc_id", "text"])
    found = pa.Table.from_batches(list(substring.chunk_rows([batch]))).to_pylist()
    for k, text in enumerate(given):
        own = [r for r in found if r["doc_id"] == k]
        assert "".join(text[r["start"] : r["stop"]] for r in own) == text
        alone = pa.record_batch([pa.array([k]), pa.array([text])], names=["doc_id", "text"])
        assert [r for b in substring.chunk_rows([alone]) for r in b.to_pylist()] == own


def test_insertions_move_few_cuts():
    rng = random.Random(6)
    text = "".join(rng.choices("abcdefghij ", k=6000))
    changed = text[:3000] + "inserted" + text[3000:]
    sets = []
    for t in (text, changed):
        flat, offsets = text_bytes(pa.array([t]))
        ends = substring.cuts(flat, offsets)[0]
        sets.append({t[a:b] for a, b in zip([0, *ends[:-1]], ends)})
    assert len(sets[0] - sets[1]) <= 3


def passages(spark, given, **options):
    return substring.repeated_passages(texts(spark, *given), **options)


def test_shared_passages_are_found(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=rng.randint(2, 9)))
    shared = " ".join(word() for _ in range(55))
    other = [" ".join(word() for _ in range(120)) for _ in range(8)]
    given = [f"{other[0]} {shared} {other[1]}", f"{other[2]} {shared}", f"{shared} {other[3]}", other[4], other[5], f"{other[6]} {other[6]}", None, ""]
    got = passages(spark, given).collect()
    assert {r.doc_id for r in got} == {0, 1, 2}
    assert {r.doc_id for r in got if not r.removed} == {0} and {r.first_doc_id for r in got} == {0}
    for r in got:
        assert given[r.doc_id][r.start : r.stop] in shared and r.stop - r.start > len(shared) / 2
    assert {r.doc_id for r in passages(spark, given, within=True).collect()} == {0, 1, 2, 5}
    cut = {r.doc_id: r.text for r in substring.without_repeats(texts(spark, *given)).collect()}
    assert cut[0] == given[0] and cut[3] == given[3] and cut[6] is None
    assert len(cut[1]) < len(given[1]) - len(shared) / 2


def plain_chunks(text):
    """Chunks (start, stop, bytes) of one text, each cut looked for by itself."""
    data = text.encode()
    value = []
    for i in range(len(data)):
        total = 0
        for back in range(min(substring.HASHED, i + 1)):
            total += int(substring.GEAR[data[i - back]]) << back
        value.append(total % (1 << 32))
    reach, ends = substring.REACH, []
    for i in range(reach + substring.HASHED, len(data) - reach):
        if value[i] > max(value[i - reach : i]) and value[i] >= max(value[i + 1 : i + reach + 1]):
            ends.append(i + 1)
    out, begin = [], 0
    for end in [*ends, len(data)]:
        while end - begin > substring.LONGEST:
            out.append((begin, begin + substring.LONGEST))
            begin += substring.LONGEST
        if end > begin:
            out.append((begin, end))
        begin = end
    # The tests' texts are ASCII: bytes are code points.
    return [(a, b, data[a:b]) for a, b in out]


def plain_passages(documents, least, within):
    """Passages of (doc_id, text) rows by a dictionary of all chunks."""
    below = lambda doc: -1 if doc is None else doc
    places, texts_seen = {}, sorted({(below(d), t) for d, t in documents if t})
    for doc, text in texts_seen:
        for a, b, data in plain_chunks(text):
            places.setdefault(data, []).append((doc, text, a))
    found = []
    for doc, text in texts_seen:
        runs, last = [], None
        for a, b, data in plain_chunks(text):
            seen = places[data]
            if len({p if within else p[0] for p in seen}) > 1:
                first = min(p[0] for p in seen)
                # Which text of an id, or which place in it, comes first is only fixed for unique ids.
                removed = (doc, text, a) != min(seen) if within else doc != first
                if last != a:
                    runs.append([])
                runs[-1].append((a, b, first, removed))
                last = b
        for run in runs:
            if run[-1][1] - run[0][0] < least:
                continue
            for removed, group in itertools.groupby(run, key=lambda c: c[3]):
                group = list(group)
                first = min(c[2] for c in group)
                found.append((None if doc == -1 else doc, group[0][0], group[-1][1], len(group), None if first == -1 else first, removed))
    return sorted(found, key=repr)


@pytest.mark.parametrize("within", [False, True])
def test_passages_equal_the_plain_version(spark, within):
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=rng.randint(2, 9)))
    pool = [" ".join(word() for _ in range(rng.choice([6, 12, 20, 60]))) for _ in range(12)]
    given = []
    for doc in range(60):
        parts = [rng.choice(pool) if rng.random() < 0.6 else " ".join(word() for _ in range(25)) for _ in range(rng.randint(1, 7))]
        given.append((doc, " ".join(parts)))
    given += [(None, f"{pool[0]} {pool[1]}"), (60, "a" * 5000), (61, "a" * 5000 + pool[2]), (62, ""), (63, None), (5, given[5][1])]
    frame = spark.createDataFrame(given, "doc_id bigint, text string")
    want = plain_passages(given, 80, within)
    assert rows(substring.repeated_passages(frame, 80, within)) == want
    assert {r[-1] for r in want} == {False, True} and any(r[2] - r[1] < 80 for r in want)


def test_runs_keep_their_short_stretches(spark):
    """Chunks of a passage seen earlier elsewhere make no holes in it."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 9))) for _ in range(60)]
    shared = " ".join(words)
    inner = shared[len(shared) // 2 - 70 : len(shared) // 2 + 70]
    given = [(1, f"{inner} zz"), (3, shared), (9, shared)]
    got = substring.repeated_passages(spark.createDataFrame(given, "doc_id bigint, text string")).collect()
    for doc in (3, 9):
        spans = sorted((r.start, r.stop) for r in got if r.doc_id == doc)
        assert spans[0][0] == 0 and spans[-1][1] == len(shared)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert {r.removed for r in got if r.doc_id == 9} == {True}


def test_repeats_inside_the_first_document_stay(spark):
    rng = random.Random(9)
    shared = " ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(2, 9))) for _ in range(60))
    given = texts(spark, f"{shared} ## {shared}", shared)
    got = substring.repeated_passages(given).collect()
    assert not any(r.removed for r in got if r.doc_id == 0) and all(r.removed for r in got if r.doc_id == 1)
    assert len([r for r in got if r.doc_id == 0]) == 2


def test_substring_odd_inputs(spark):
    got = substring.repeated_passages(odd_documents(spark)).collect()
    assert got == []
    assert substring.repeated_passages(no_documents(spark)).count() == 0


# -- fingerprints ----------------------------------------------------------------------------------------------


def entropy_step(window):
    total = sum(int(fingerprint.TERM[n]) for n in np.unique(window, return_counts=True)[1])
    return int(np.float32(int(fingerprint.TERM[fingerprint.WINDOW]) - total) * np.float32((fingerprint.LEVELS - 1) / int(fingerprint.TERM[fingerprint.WINDOW])))


def test_entropy_of_every_window():
    flat = np.random.default_rng(1).choice(np.frombuffer(b"aaabbcdefg  ", np.uint8), 3000)
    levels = fingerprint.entropy_levels(flat)
    assert len(levels) == 3000 - fingerprint.WINDOW + 1
    assert all(levels[i] == entropy_step(flat[i : i + fingerprint.WINDOW]) for i in range(0, len(levels), 7))


def test_features_do_not_depend_on_the_slice():
    rng = random.Random(3)
    given = ["".join(rng.choices("abcdefgh ", k=k)) for k in (0, 3, 40, 127, 128, 600, 5000)] + ["z" * 400]
    printer = fingerprint.Printer(np.arange(fingerprint.LEVELS))
    for together, text in zip(printer.digests(given), given):
        assert (together == printer.digests([text])[0]).all()
        assert (fingerprint.read(fingerprint.written(together)) == together).all()


def test_edited_fingerprints(spark):
    rng = random.Random(5)
    given = [(i, "".join(rng.choices("abcdefghijklmnop é", k=rng.choice([0, 5, 90, 700, 4000])))) for i in rng.sample(range(1000), 60)]
    given[3] = (given[3][0], None)
    given[5] = (given[5][0], given[6][1])
    frame = spark.createDataFrame(given, "doc_id bigint, text string")
    given = sorted((i, t or "") for i, t in given)
    for parts in (1, 5, 90):
        got = sorted(fingerprint.edited_fingerprints(frame, parts).collect())
        assert [r.doc_id for r in got] == [i for i, _ in given]
        for k, (row, (_, text)) in enumerate(zip(got, given)):
            after, cut = given[(k + 1) % len(given)][1], len(text) // 4
            edited = text[: len(text) - cut] + after[:cut] if cut else text
            assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert 0 <= row.near_next <= 1 and (row.near_edited > 0.4 or len(text) < 10)
    prints = {}
    for row, (_, text) in zip(got, given):
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint


def test_fingerprint_odd_inputs(spark):
    odd = odd_documents(spark)
    got = fingerprint.edited_fingerprints(odd, 3).collect()
    assert len(got) == 10 and {r.fingerprint for r in got if r.doc_id in (2, 3)} == {""}
    assert fingerprint.fingerprints(odd).count() == 10
    assert fingerprint.edited_fingerprints(no_documents(spark), 3).count() == 0
    alone = fingerprint.edited_fingerprints(texts(spark, "only one text " * 30), 3).first()
    assert alone.near_next == 1.0
