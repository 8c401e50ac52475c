"""Chat formatting at token level: segments are encoded apart and reserved ids put between them.

A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>``. The three control tokens are reserved ids, so no text can
produce them. So that the readable form is safe too, a control string inside a role or text gets one more backslash
after ``<|``; reading takes one off again. The loss mask covers the tokens of assistant texts and nothing else; it is
the running sum of +1 at the first and -1 after the last such token.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.bpe import encoding
from eventlake.llm.common import slices

# The reserved ids follow the 50,256 ranks of the vocabulary and its end-of-text id.
START, SEP, END = 50257, 50258, 50259
CONTROL = {START: "<|im_start|>", SEP: "<|im_sep|>", END: "<|im_end|>"}
PLAIN = regex.compile(r"<\|(\\*)(im_start|im_sep|im_end)\|>")
ESCAPED = regex.compile(r"<\|\\(\\*)(im_start|im_sep|im_end)\|>")
TRAINED_ROLE = "assistant"
FORMATTED = "conv_id bigint, turn bigint, ids array<int>, mask array<boolean>"


def escape(text: str) -> str:
    return PLAIN.sub(r"<|\\\1\2|>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<|\1\2|>", text)


def assemble(role: str, text: str, encode) -> tuple[np.ndarray, np.ndarray]:
    """Ids of one turn and its loss mask."""
    named, said = encode(escape(role)), encode(escape(text))
    ids = np.array([START, *named, SEP, *said, END], dtype=np.int32)
    steps = np.zeros(len(ids) + 1, dtype=np.int8)
    if role == TRAINED_ROLE:
        steps[len(named) + 2] += 1
        steps[len(named) + 2 + len(said)] -= 1
    return ids, np.cumsum(steps)[:-1].astype(bool)


def format_turns(conversations: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per turn: conv_id, turn, token ids and loss mask; a conversation's output is its rows by turn.

    Null role or text: empty. Null conv_id or turn stay null. Repeated rows stay repeated. Every row is encoded where
    it is read, so a conversation of any length is spread over all tasks.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches):
        encode = encoding(vocabulary).encode_ordinary
        for part in slices(batches):
            made = [assemble(role, text, encode) for role, text in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
            yield pa.record_batch(
                [part.column(0), part.column(1), pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.bool_()))],
                names=["conv_id", "turn", "ids", "mask"],
            )

    return rows.mapInArrow(run, FORMATTED)


def segments(ids: list[int], decode) -> tuple[str, str, list[tuple[int, int]]]:
    """Role and text of one formatted turn, and the token ranges they stand in."""
    sep = ids.index(SEP)
    if ids[0] != START or ids[-1] != END:
        raise ValueError("not a formatted turn")
    return decode(ids[1:sep]), decode(ids[sep + 1 : -1]), [(1, sep), (sep + 1, len(ids) - 1)]


READ_BACK = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(formatted: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Digests of what the formatted rows say, per conversation.

    Turns are read in order of turn, then of ids where turns tie (null turns first). Rows stream through their task in order, so
    a very long conversation needs no more memory than its longest turn.
    """
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "ids")

    def run(batches: Iterator[pa.RecordBatch]):
        decode = encoding(vocabulary).decode
        current, out = None, []
        for batch in batches:
            for conv, ids, mask in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if current is None or current[0] != conv:
                    if current is not None:
                        out.append(current)
                    current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, _ = segments(ids, decode)
                learned = unescape(decode([i for i, m in zip(ids, mask) if m and i not in CONTROL]))
                current[1] += 1
                current[2].update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
                current[3] += len(learned)
                current[4].update(learned.encode("utf-8", "surrogatepass"))
                current[5] += len(role) + len(text) + sum(map(len, CONTROL.values()))
            if len(out) >= 10_000:
                yield told(out)
                out = []
        if current is not None:
            out.append(current)
        if out:
            yield told(out)

    return ordered.mapInArrow(run, READ_BACK)


def told(rows: list[list]) -> pa.RecordBatch:
    conv, turns, said, chars, learned, whole = zip(*rows)
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    values = (conv, turns, [h.hexdigest() for h in said], chars, [h.hexdigest() for h in learned], whole)
    names = [f.split()[0] for f in READ_BACK.split(", ")]
    return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], names=names)
