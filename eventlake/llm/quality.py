"""Byte-level convolutional classifier in numpy.

A text is cut into overlapping chunks that cover every byte. In each chunk learned filters run over embedded bytes
and are max-pooled; a hidden layer reads the pooled filters of a chunk, so it can also see that few different
patterns occur. The hidden units are max-pooled over all chunks of the text and combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import sampled, slices, text_bytes, texts_of

CHUNK, OVERLAP = 512, 64
EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 8, 8, 2, 24, 16
# Texts that score lower count as rejected.
GOOD = 0.7
# The bounded training sample: rows of each class, and chunks (spread over the text) of each row.
SAMPLE_PER_CLASS = 2000
SAMPLE_CHUNKS = 6
STEPS, BATCH, RATE = 700, 48, 3e-3
PAD = 256
# Chunks that go through the filters together.
BLOCK = 256

Model = dict[str, np.ndarray]


def chunk_starts(size: int) -> list[int]:
    """Starts of the chunks of a text; the last one ends with the text, so that chunks are full where possible."""
    if size <= CHUNK:
        return [0]
    starts = list(range(0, size - CHUNK, CHUNK - OVERLAP))
    return [*starts, size - CHUNK]


def cut(flat: np.ndarray, offsets: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of all texts as rows of byte values (257 values, ``PAD`` past the end) and each chunk's text."""
    begins, owners, ends = [], [], []
    for k in range(len(offsets) - 1):
        starts = chunk_starts(int(offsets[k + 1] - offsets[k]))
        if most and len(starts) > most:
            starts = [starts[i] for i in np.linspace(0, len(starts) - 1, most).astype(int)]
        begins += [int(offsets[k]) + s for s in starts]
        owners += [k] * len(starts)
        ends += [int(offsets[k + 1])] * len(starts)
    at = np.array(begins)[:, None] + np.arange(CHUNK)
    inside = at < np.array(ends)[:, None]
    padded = np.concatenate([flat, np.zeros(1, np.uint8)]).astype(np.int16)
    return np.where(inside, padded[np.minimum(at, len(flat))], PAD), np.array(owners)


def convolve(chunks: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pooled filters per chunk, where their maximum was, and the windows."""
    n = len(chunks)
    seen = model["embed"][chunks].reshape(n, CHUNK * EMBED)
    windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]
    values = np.ascontiguousarray(windows).reshape(-1, WIDTH * EMBED) @ model["filters"]
    values = values.reshape(n, -1, FILTERS) + model["filter_bias"]
    where = values.argmax(axis=1) if model.get("training") is not None else None
    return np.maximum(values.max(axis=1), 0), where, windows


def hidden(pooled: np.ndarray, model: Model) -> np.ndarray:
    return np.maximum(pooled @ model["mix"] + model["mix_bias"], 0)


def top_by_owner(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Maximum of each column over the rows of an owner; owners ascend and none is missing."""
    return np.maximum.reduceat(values, np.flatnonzero(np.r_[True, np.diff(owners) > 0]), axis=0)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(flat: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Probabilities of texts laid end to end; chunks are handled in blocks, so memory is bounded by the texts."""
    if len(offsets) < 2:
        return np.empty(0)
    best = np.full((len(offsets) - 1, HIDDEN), -np.inf, np.float32)
    # Blocks of whole texts; a very long text is cut into runs of chunks.
    for chunks, owners in blocks(flat, offsets):
        units = hidden(convolve(chunks, model)[0], model)
        present = np.unique(owners)
        best[present] = np.maximum(best[present], top_by_owner(units, owners))
    return sigmoid(best @ model["out"] + model["out_bias"])


def blocks(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = CHUNK - OVERLAP
    counts = np.where(np.diff(offsets) <= CHUNK, 1, 1 + -(-(np.diff(offsets) - CHUNK) // step))
    owners = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    sizes = np.diff(offsets)[owners]
    begins = offsets[:-1][owners] + np.minimum(number * step, np.maximum(sizes - CHUNK, 0))
    ends = offsets[1:][owners]
    padded = np.concatenate([flat, np.zeros(1, np.uint8)]).astype(np.int16)
    for i in range(0, len(owners), BLOCK):
        at = begins[i : i + BLOCK, None] + np.arange(CHUNK)
        yield np.where(at < ends[i : i + BLOCK, None], padded[np.minimum(at, len(flat))], PAD), owners[i : i + BLOCK]


def start_model(seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    model = {
        "embed": rng.normal(0, 0.5, (257, EMBED)),
        "filters": rng.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)),
        "filter_bias": np.zeros(FILTERS),
        "mix": rng.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, HIDDEN)),
        "mix_bias": np.full(HIDDEN, 0.1),
        "out": rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN),
        "out_bias": np.zeros(()),
    }
    return {k: v.astype(np.float32) for k, v in model.items()}


def gradients(chunks: np.ndarray, owners: np.ndarray, target: np.ndarray, weight: np.ndarray, model: Model) -> Model:
    """Gradients of the weighted log loss over texts given as chunks."""
    pooled, where, windows = convolve(chunks, {**model, "training": True})
    units = hidden(pooled, model)
    starts = np.flatnonzero(np.r_[True, np.diff(owners) > 0])
    best = np.maximum.reduceat(units, starts, axis=0)
    error = weight * (sigmoid(best @ model["out"] + model["out_bias"]) - target)
    grad = {"out": best.T @ error, "out_bias": error.sum()}
    # Only the first chunk that reaches a maximum learns from it.
    back = (error[:, None] * model["out"])[owners] * (units == best[owners]) * (units > 0)
    order = np.cumsum(units == best[owners], axis=0)
    before = np.concatenate([np.zeros((1, HIDDEN), order.dtype), order])[starts]
    back = back * (order - before[owners] == 1)
    grad["mix"], grad["mix_bias"] = pooled.T @ back, back.sum(axis=0)
    down = (back @ model["mix"].T) * (pooled > 0)
    rows = np.arange(len(chunks))
    grad["filter_bias"] = down.sum(axis=0)
    grad["filters"] = np.empty_like(model["filters"])
    seen = np.zeros((257, EMBED), np.float32)
    for f in range(FILTERS):
        at = where[:, f]
        grad["filters"][:, f] = down[:, f] @ windows[rows, at]
        bytes_there = chunks[rows[:, None], at[:, None] * STRIDE + np.arange(WIDTH)].ravel()
        share = np.repeat(down[:, f], WIDTH)
        kernel = np.tile(model["filters"][:, f].reshape(WIDTH, EMBED), (len(chunks), 1))
        for e in range(EMBED):
            seen[:, e] += np.bincount(bytes_there, share * kernel[:, e], 257)
    grad["embed"] = seen
    return grad


def train(chunks: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Adam over batches with both classes in equal parts; one class only gives a constant score."""
    model = start_model(seed)
    sides = [np.flatnonzero(labels == side) for side in (0, 1)]
    if not len(sides[0]) or not len(sides[1]):
        model["out"][:] = 0
        model["out_bias"] = np.float32(0 if len(labels) == 0 else 3 if len(sides[1]) else -3)
        return model
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    for step in range(1, STEPS + 1):
        picked = np.concatenate([rng.choice(side, BATCH // 2) for side in sides])
        rows = np.concatenate([chunks[i] for i in picked])
        owners = np.repeat(np.arange(BATCH), [len(chunks[i]) for i in picked])
        grad = gradients(rows, owners, labels[picked], np.full(BATCH, 1 / BATCH, np.float32), model)
        rate = RATE * min(1, 3 * (1 - step / (STEPS + 1)))
        for k in model:
            first[k] = 0.9 * first[k] + 0.1 * grad[k]
            second[k] = 0.99 * second[k] + 0.01 * grad[k] ** 2
            model[k] = (model[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def sample_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        rows, owners = cut(*text_bytes(part.column(2)), most=SAMPLE_CHUNKS)
        packed = [rows[owners == k].astype("<u2").tobytes() for k in range(part.num_rows)]
        yield pa.record_batch([part.column(0), part.column(1), pa.array(packed, pa.binary())], names=["doc_id", "label", "chunks"])


def fit(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Train on a bounded sample of labelled rows for which ``learn`` (over ``doc_id``) holds.

    The driver receives at most about 2 x ``per_class`` rows of ``SAMPLE_CHUNKS`` chunks each. Null labels and
    labels without a document are left out.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where(learn & F.col("label").isin(0, 1))
    ids = F.broadcast(sampled(known, "label", per_class))
    rows = texts_of(documents).join(ids, "doc_id").select("doc_id", "label", "text")
    found = rows.mapInArrow(sample_chunks, "doc_id bigint, label int, chunks binary").toPandas().sort_values(["doc_id", "chunks"], kind="stable")
    chunks = [np.frombuffer(c, "<u2").reshape(-1, CHUNK).astype(np.int16) for c in found["chunks"]]
    return train(chunks, found["label"].to_numpy(np.float32))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every whole text.

    A null or empty text is scored as one chunk of padding. Repeated rows give a row each; a null id stays null. No
    other column is read.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches):
            found = scores(*text_bytes(part.column(1)), held.value)
            yield pa.record_batch([part.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return texts_of(documents).mapInArrow(run, "doc_id bigint, score double")


def keep_good(documents: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents with a score of at least ``least``, scored where they are read, all columns as they were."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index("text")

    def run(batches):
        for part in slices(batches):
            found = scores(*text_bytes(part.column(place)), held.value)
            kept = part.filter(pa.array(found >= least))
            if kept.num_rows:
                yield kept

    return documents.mapInArrow(run, documents.schema)
