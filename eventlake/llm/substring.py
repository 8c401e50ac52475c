"""Substring deduplication by content-defined chunks.

A gear rolling hash runs over the bytes of a text; a chunk ends where the hash is larger than at the ``REACH`` bytes on
both sides. That depends on nearby bytes only, so an insertion moves no other cut. Chunks are matched by a 128-bit
digest over the whole corpus; neighbouring chunks that repeat make a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import slices, text_bytes, texts_of

# Bytes the rolling hash depends on, bytes on each side that a cut must beat, and bytes after which a chunk is cut
# anyway (runs of one byte have no cut).
HASHED, REACH, LONGEST = 16, 24, 1024
# A repeated passage has at least that many characters.
LEAST_CHARS = 80
CHUNKS = "doc_id bigint, text_key bigint, start int, stop int, hi bigint, lo bigint"


def gear_table() -> np.ndarray:
    """256 well-mixed 32-bit numbers from a multiplicative rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0xD1B54A32D192ED03)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = gear_table()


def rolling(flat: np.ndarray) -> np.ndarray:
    """Gear hash of the last ``HASHED`` bytes at each byte: each step shifts the older bytes one bit further."""
    out, width = GEAR[flat], 1
    while width < HASHED:
        older = np.zeros_like(out)
        older[width:] = out[:-width] << np.uint32(width) if len(out) > width else 0
        out, width = out + older, 2 * width
    return out


def cuts(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends of all texts as byte and as character positions, the ends of the texts among them."""
    n = len(flat)
    starts = np.flatnonzero((flat & 0xC0) != 0x80)
    found = np.empty(0, np.int64)
    if n > 2 * REACH:
        value = rolling(flat)
        top, width = value, 1
        while 2 * width <= REACH:
            top, width = np.maximum(top[:-width], top[width:]), 2 * width
        top = np.maximum(top[: n - REACH + 1], top[REACH - width : n - width + 1])
        at = np.arange(REACH, n - REACH)
        at = at[(value[at] > top[at - REACH]) & (value[at] >= top[at + 1])]
        # The bytes looked at must lie in one text.
        owner = np.searchsorted(offsets, at, side="right") - 1
        found = at[(at - offsets[owner] >= REACH + HASHED) & (offsets[owner + 1] - at > REACH)] + 1
    ends = np.union1d(found, offsets[1:][np.diff(offsets) > 0]).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    extra = (ends - begins - 1) // LONGEST
    if extra.any():
        many = np.repeat(begins, extra)
        step = np.arange(len(many)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        ends = np.union1d(ends, many + step * LONGEST)
    bounds = np.append(starts, n)
    place = np.searchsorted(bounds, ends)
    return np.unique(bounds[place]), np.unique(place)


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        flat, offsets = text_bytes(part.column(1))
        ends, chars = cuts(flat, offsets)
        if not len(ends):
            continue
        begins, first_chars = np.concatenate([[0], ends[:-1]]), np.concatenate([[0], chars[:-1]])
        owner = np.searchsorted(offsets, begins, side="right") - 1
        char_at = np.concatenate([[0], chars])[np.searchsorted(np.concatenate([[0], ends]), offsets[:-1])]
        data = flat.tobytes()
        digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]), "<i8").reshape(-1, 2)
        keys = np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.uint64).view(np.int64)
        yield pa.record_batch(
            [
                part.column(0).take(pa.array(owner)),
                pa.array(keys[owner]),
                pa.array((first_chars - char_at[owner]).astype(np.int32)),
                pa.array((chars - char_at[owner]).astype(np.int32)),
                pa.array(digests[:, 0]),
                pa.array(digests[:, 1]),
            ],
            names=["doc_id", "text_key", "start", "stop", "hi", "lo"],
        )


def chunks(documents: DataFrame) -> DataFrame:
    """All chunks: ``doc_id``, a key of the text, code points ``start`` and ``stop`` (end exclusive), the digest."""
    return texts_of(documents).mapInArrow(chunk_rows, CHUNKS)


def repeated_passages(documents: DataFrame, least_chars: int = LEAST_CHARS, within: bool = False) -> DataFrame:
    """Passages of at least ``least_chars`` code points that occur in several documents.

    Neighbouring chunks of a text that occur in several documents make a run, and only the whole run must have the
    least length. It comes as one row for each stretch with one value of ``removed``: ``doc_id``, ``start``, ``stop``,
    ``n_chunks``, ``first_doc_id`` (the smallest document that has a chunk of it) and ``removed`` (false where it stays:
    in the smallest document, with all its own repeats). With ``within`` repeats inside one document count as well, and
    only the first occurrence of a chunk stays. Null and empty texts have no chunks. Repeated rows (same id and text)
    count as one; the same id with other texts counts as one document. All null ids are one document, the smallest, and
    ``first_doc_id`` is null for it.

    Chunks are combined on the map side before they are matched, so a passage in a third of all documents reaches
    the match as one row per task; the join back is one of plain equality, which adaptive execution splits.
    """
    # In a struct null sorts below every value.
    every = chunks(documents).withColumn("place", F.struct("doc_id", "text_key", "start"))
    first, last = F.min("place"), F.max("place")
    several = ~(first.eqNullSafe(last) if within else first["doc_id"].eqNullSafe(last["doc_id"]))
    known = every.groupBy("hi", "lo").agg(first.alias("first"), several.alias("several")).where("several").select("hi", "lo", "first")
    stays = F.col("place").eqNullSafe(F.col("first")) if within else F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    found = every.join(known, ["hi", "lo"]).select("doc_id", "text_key", "start", "stop", F.struct("first.doc_id").alias("first"), (~stays).alias("removed"))
    text = Window.partitionBy("doc_id", "text_key").orderBy("start")
    run_begins = F.coalesce(F.lag("stop").over(text) != F.col("start"), F.lit(True))
    begins = run_begins | (F.lag("removed").over(text) != F.col("removed"))
    marked = found.dropDuplicates(["doc_id", "text_key", "start"]).withColumns({"run": F.when(run_begins, F.col("start")), "begin": F.when(begins, F.col("start"))})
    marked = marked.withColumns({c: F.last(c, ignorenulls=True).over(text) for c in ("run", "begin")})
    passages = marked.groupBy("doc_id", "text_key", "run", F.col("begin").alias("start")).agg(
        F.max("stop").alias("stop"), F.count("*").alias("n_chunks"), F.min("first")["doc_id"].alias("first_doc_id"), F.first("removed").alias("removed")
    )
    run_stop = F.max("stop").over(Window.partitionBy("doc_id", "text_key", "run"))
    long_enough = passages.withColumn("run_stop", run_stop).where(F.col("run_stop") - F.col("run") >= least_chars)
    return long_enough.select("doc_id", "start", "stop", "n_chunks", "first_doc_id", "removed")


def without_repeats(documents: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents with all but the first occurrence of each repeated passage cut out of ``text``.

    Expects ids that are unique and not null; all other columns stay as they are.
    """
    gone = repeated_passages(documents, least_chars).where("removed")
    spans = gone.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_spans"))

    def step(acc, span):
        between = F.substring(F.col("text"), acc["at"] + 1, F.greatest(span["start"] - acc["at"], F.lit(0)))
        return F.struct(F.concat(acc["kept"], between).alias("kept"), span["stop"].alias("at"))

    start = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))
    rest = F.aggregate("_spans", start, step, lambda acc: F.concat(acc["kept"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    joined = documents.join(spans, "doc_id", "left")
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(rest)).select(*documents.columns)
