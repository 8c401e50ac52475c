"""Document fingerprints from statistically improbable features.

Every window of ``WINDOW`` bytes gets the Shannon entropy of its bytes, in steps. How rare each step is over the whole
corpus ranks the windows: rarer is better. Of each run of ``SPREAD`` windows the best one (the leftmost of equals)
gets a point; windows with enough points are the features. Features go in order into a chain of Bloom filters, a new
one when one is full. Likeness compares the bits two filters share with what chance gives.

Windows and ranks depend on nearby bytes only, so an edit changes only the features around it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import slices, text_bytes

WINDOW = 32
SPREAD = 32
LEAST_POINTS = 8
LEVELS = 512
# One filter: bits, hashes per feature, features when full.
BITS, HASHES, FULL = 2048, 5, 160
# Documents that one range of ids holds at most, about.
RANGE_ROWS = 50_000
# Bytes that the vectorised entropy works on at once.
BLOCK = 1 << 17
# n * log2(n) in steps of 2**-16, for counts up to the window: whole numbers, so sums do not depend on their order.
TERM = np.round(np.array([0.0, *(n * np.log2(n) for n in range(1, WINDOW + 1))]) * 65536).astype(np.int32)
GAIN = np.diff(TERM, prepend=0).astype(np.int32)
# Texts of fewer characters have all their windows of SHORT_WINDOW bytes as features.
SHORT, SHORT_WINDOW = 128, 8


def entropy_levels(flat: np.ndarray) -> np.ndarray:
    """The entropy step (0 to ``LEVELS`` - 1) of the window that starts at each byte, for all full windows."""
    n = len(flat) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.int16)
    out = np.empty(n, np.int16)
    # Entropy is log2(WINDOW) less the mean of n * log2(n).
    most, step = TERM[WINDOW], np.float32((LEVELS - 1) / TERM[WINDOW])
    for a in range(0, n, BLOCK):
        part = flat[a : min(a + BLOCK, n) + WINDOW - 1]
        # How often a byte occurs among the bytes up to it (from it on) that lie in one window with it.
        behind, ahead = np.ones(len(part), np.uint8), np.ones(len(part), np.uint8)
        for lag in range(1, WINDOW):
            same = (part[lag:] == part[:-lag]).view(np.uint8)
            behind[lag:] += same
            ahead[:-lag] += same
        m = len(part) - WINDOW + 1
        first = GAIN[behind[:WINDOW]].sum()
        change = GAIN[behind[WINDOW:]] - GAIN[ahead[: m - 1]]
        out[a] = np.float32(most - first) * step
        out[a + 1 : a + m] = (most - first - np.cumsum(change, dtype=np.int32)).astype(np.float32) * step
    return out


def windows_inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which of the n windows of texts laid end to end lie inside one text."""
    inside = np.zeros(n, bool)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= WINDOW:
            inside[a : b - WINDOW + 1] = True
    return inside


def count_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many windows of a task have each entropy step."""
    counts = np.zeros(LEVELS, np.int64)
    for part in slices(batches):
        flat, offsets = text_bytes(part.column(0))
        levels = entropy_levels(flat)
        counts += np.bincount(levels[windows_inside(offsets, len(levels))], minlength=LEVELS)
    yield pa.record_batch([pa.array(np.arange(LEVELS, dtype=np.int32)), pa.array(counts)], names=["level", "n"])


def corpus_ranks(documents: DataFrame, text_col: str = "text") -> np.ndarray:
    """The rank of each entropy step over all texts, rarest first; steps that do not occur share the first ranks."""
    found = documents.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(count_levels, "level int, n bigint")
    counts = np.zeros(LEVELS, np.int64)
    for level, n in found.groupBy("level").agg(F.sum("n")).collect():
        counts[level] = n
    order = np.lexsort((np.arange(LEVELS), counts))
    ranks = np.empty(LEVELS, np.int64)
    ranks[order] = np.arange(LEVELS)
    return ranks


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def feature_hashes(flat: np.ndarray, starts: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """A 64-bit hash of the window at each start."""
    lanes = np.ascontiguousarray(flat[starts[:, None] + np.arange(width)]).view("<u8")
    found = np.full(len(starts), width, np.uint64)
    for lane in range(lanes.shape[1]):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + lanes[:, lane])
    return found


def features(flat: np.ndarray, offsets: np.ndarray, n_chars: list[int], ranks: np.ndarray) -> list[np.ndarray]:
    """Feature hashes of each text in order, without repeats. A text below the short window is one feature."""
    levels = entropy_levels(flat)
    n = len(levels)
    inside = windows_inside(offsets, n)
    chosen = np.empty(0, np.int64)
    if inside.any():
        # Rank and position in one number. Windows across texts come last; as no run is longer than a window, a run
        # whose ends both lie inside texts lies inside one text.
        kind, shift = (np.uint32, 22) if n <= 1 << 22 else (np.uint64, 40)
        table = ranks.astype(kind) << kind(shift)
        best, width = np.where(inside, table[levels], kind(LEVELS << shift)) | np.arange(n, dtype=kind), 1
        while width < SPREAD and len(best) > width:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        whole = inside[: len(best)] & inside[width - 1 : width - 1 + len(best)]
        points = np.bincount((best[whole] & kind((1 << shift) - 1)).astype(np.int64), minlength=n)
        chosen = np.flatnonzero(points >= LEAST_POINTS)
    hashes = feature_hashes(flat, chosen)
    bounds = np.searchsorted(chosen, offsets)
    out = []
    for k, size in enumerate(np.diff(offsets)):
        own, a = hashes[bounds[k] : bounds[k + 1]], int(offsets[k])
        if 0 < size < SHORT_WINDOW:
            own = np.frombuffer(hashlib.sha256(flat[a : a + size].tobytes()).digest()[:8], "<u8")
        elif size and n_chars[k] < SHORT:
            own = feature_hashes(flat, a + np.arange(size - SHORT_WINDOW + 1), SHORT_WINDOW)
        elif size and not len(own):
            own = feature_hashes(flat, a + np.argsort(ranks[levels[a : a + size - WINDOW + 1]], kind="stable")[:1])
        out.append(own[np.sort(np.unique(own, return_index=True)[1])])
    return out


def digest(hashes: np.ndarray) -> np.ndarray:
    """The chain of filters of a text, one row of bits each; no features, no filter."""
    if not len(hashes):
        return np.zeros((0, BITS), bool)
    filters = np.zeros((-(-len(hashes) // FULL), BITS), bool)
    rows = np.arange(len(hashes)) // FULL
    for k in range(HASHES):
        filters[rows, ((hashes >> np.uint64(11 * k)) % np.uint64(BITS)).astype(np.int64)] = True
    return filters


def written(filters: np.ndarray) -> str:
    return base64.b64encode(np.packbits(filters, axis=1).tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.unpackbits(np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8), axis=1).astype(bool)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 (chance) to 1: each filter of the shorter chain against its best match in the other, weighted by bits.

    Equal digests have 1, two empty ones too; an empty one has 0 with any other.
    """
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if (len(a), a.sum()) > (len(b), b.sum()):
        a, b = b, a
    in_a, in_b = a.sum(axis=1), b.sum(axis=1)
    shared = a.astype(np.float32) @ b.T.astype(np.float32)
    most = np.minimum(in_a[:, None], in_b[None, :])
    chance = in_a[:, None] * in_b[None, :] / BITS
    near = np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(axis=1)
    return float((near * in_a).sum() / in_a.sum())


class Printer:
    def __init__(self, ranks: np.ndarray):
        self.ranks = ranks

    def digests(self, texts: list[str]) -> list[np.ndarray]:
        flat, offsets = text_bytes(pa.array(texts, pa.large_string()))
        return [digest(h) for h in features(flat, offsets, [len(t) for t in texts], self.ranks)]


def fingerprints(documents: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text (null: empty, with an empty fingerprint)."""
    held = documents.sparkSession.sparkContext.broadcast(corpus_ranks(documents) if ranks is None else ranks)

    def run(batches):
        printer = Printer(held.value)
        for part in slices(batches):
            found = printer.digests(part.column(1).to_pylist())
            yield pa.record_batch([part.column(0), pa.array(list(map(written, found)), pa.string())], names=["doc_id", "fingerprint"])

    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fingerprint string")


EDITED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_next(documents: DataFrame, parts: int) -> DataFrame:
    """Texts in ranges of ``doc_id``; each range also has the first document of the next one, marked ``extra``.

    So a range holds the successor of each of its documents, and a text is moved once. The first document follows
    the last. The driver learns only the bounds: one id per range.
    """
    rows = documents.select(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("place"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = [i / parts for i in range(1, parts)]
    edges = sorted(set(rows.select("place").stat.approxQuantile("place", cuts, 0.25 / parts))) if parts > 1 else []
    # The quantiles come as doubles; any rounding moves a bound, never a row.
    spot = F.lit(0)
    if edges:
        spot = F.expr("size(filter(array({}), e -> e <= place))".format(", ".join(f"{int(e)}L" for e in edges)))
    placed = rows.withColumn("range", spot)
    heads = dict(placed.groupBy("range").agg(F.min("place")).collect())
    if not heads:
        return placed.withColumn("extra", F.lit(False))
    names = sorted(heads)
    before = {heads[name]: names[k - 1] for k, name in enumerate(names)}
    moved = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    copies = F.when(F.col("place").isin(list(before)), F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("extra")), F.struct(moved[F.col("place")].alias("range"), F.lit(True).alias("extra"))))
    copies = copies.otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("extra"))))
    return placed.select("place", "doc_id", "text", F.explode(copies).alias("at")).select("place", "doc_id", "text", "at.range", "at.extra")


def edits(batches: Iterator[pa.RecordBatch], printer: Printer) -> Iterator[pa.RecordBatch]:
    """Each text with its successor in the stream; see ``edited_fingerprints``."""
    waiting: tuple | None = None  # the last document of the slice before, with its digest

    for part in slices(batches):
        rows = list(zip(*(part.column(k).to_pylist() for k in (1, 2, 3, 4))))
        own = printer.digests([text for _, text, _, _ in rows])
        line = ([waiting] if waiting else []) + [(*row, print_) for row, print_ in zip(rows, own)]
        pairs = [(a, b) for a, b in zip(line, line[1:]) if not a[3] and a[2] == b[2]]
        waiting = line[-1]
        if pairs:
            yield told(pairs, printer)


def told(pairs: list[tuple], printer: Printer) -> pa.RecordBatch:
    changed = []
    for (_, text, _, _, _), (_, after, _, _, _) in pairs:
        k = len(text) // 4
        changed.append(text[: len(text) - k] + after[:k] if k else text)
    prints = printer.digests(changed)
    columns = (
        [a[0] for a, _ in pairs],
        [len(a[1]) for a, _ in pairs],
        [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed],
        [written(a[4]) for a, _ in pairs],
        [written(p) for p in prints],
        [likeness(a[4], p) for (a, _), p in zip(pairs, prints)],
        [likeness(a[4], b[4]) for a, b in pairs],
    )
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in EDITED.split(", ")])


def edited_fingerprints(documents: DataFrame, parts: int, ranks: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of each text and of its edit, and likeness to the edit and to the next document's.

    The edit replaces the last quarter of the code points by the first ones of the next document by ``doc_id`` (after
    the last: the first). Null text: empty. Rows that share an id follow one another in order of their text; a null id
    comes first. A single document is its own successor.
    """
    held = documents.sparkSession.sparkContext.broadcast(corpus_ranks(documents) if ranks is None else ranks)
    rows = with_next(documents, parts)
    rows = rows.repartition(parts, "range").sortWithinPartitions("range", "extra", "place", "text")
    rows = rows.select("place", "doc_id", "text", F.col("range").cast("int"), "extra")
    return rows.mapInArrow(lambda batches: edits(batches, Printer(held.value)), EDITED)


def even_parts(documents: DataFrame, rows: int = RANGE_ROWS) -> int:
    """Ranges for ``edited_fingerprints``: as many as a shuffle has, more for more than ``rows`` documents in each."""
    least = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, -(-documents.count() // rows))
