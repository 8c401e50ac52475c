"""Fill-in-middle transformation: each text is cut at two unit boundaries and its parts are put in another order.

A unit is a run of white space with the word after it, or white space at the end of the text. A Fenwick tree over fixed
blocks of a text's bytes holds how many units end and how many code points begin in each block. A descent by powers of
two finds the block in which the k-th unit ends together with the counts before it; only that block is then searched.
So a cut costs a logarithm of the blocks and one block, however long the text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import slices, text_bytes, texts_of

# Bytes of one block of the tree.
BLOCK_BYTES = 512
MARKERS = ("<P>", "<S>", "<M>")
FORMED = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class BlockTree:
    """Fenwick tree over the blocks of one text; each node has two sums: unit ends and code points."""

    def __init__(self, ends: np.ndarray, points: np.ndarray, block: int = BLOCK_BYTES):
        self.ends, self.points, self.block = ends, points, block
        starts = np.arange(0, len(ends), block)
        self.size = len(starts)
        self.sums = np.zeros((self.size + 1, 2), dtype=np.int64)
        if self.size:
            self.sums[1:, 0] = np.add.reduceat(ends, starts, dtype=np.int64)
            self.sums[1:, 1] = np.add.reduceat(points, starts, dtype=np.int64)
        step = 1
        while step <= self.size:  # a node of span 2 x step takes the sum of the node in its middle
            self.sums[2 * step :: 2 * step] += self.sums[step :: 2 * step][: len(self.sums[2 * step :: 2 * step])]
            step *= 2

    def total(self) -> tuple[int, int]:
        """Units and code points of the whole text."""
        at, units, points = self.size, 0, 0
        while at:
            units, points = units + int(self.sums[at, 0]), points + int(self.sums[at, 1])
            at &= at - 1
        return units, points

    def cut(self, k: int) -> tuple[int, int]:
        """Byte offset behind the k-th unit (0: the start), and the code points before it."""
        if k <= 0:
            return 0, 0
        at, points, left = 0, 0, k
        step = 1 << self.size.bit_length()
        while step:
            if at + step <= self.size and self.sums[at + step, 0] < left:
                at += step
                left -= int(self.sums[at, 0])
                points += int(self.sums[at, 1])
            step >>= 1
        start = at * self.block
        inside = int(np.flatnonzero(self.ends[start : start + self.block])[left - 1]) + 1
        return start + inside, points + int(np.count_nonzero(self.points[start : start + inside]))


def marks(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts of a slice: whether a unit ends with it, and whether a code point begins there."""
    points = (flat & 0xC0) != 0x80
    white = WHITE[flat]
    after = np.ones(len(flat), dtype=bool)
    after[:-1] = white[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    after[last] = True
    ends = ~white & after
    ends[last] = True  # white space at the end of a text is a unit of its own
    return ends, points


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers that depend on the seed and the id only (a null id counts as empty text)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def arrange(text: bytes, tree: BlockTree, numbers: list[int], rate: int, spm_rate: int):
    """Units, form, code points of prefix and middle (none if plain), and the output of one text."""
    units, _ = tree.total()
    if not text or numbers[2] % 100 >= rate or any(marker.encode() in text for marker in MARKERS):
        return units, "plain", None, None, text
    first, second = sorted(number % (units + 1) for number in numbers[:2])
    (a, a_points), (b, b_points) = tree.cut(first), tree.cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if numbers[3] % 100 < spm_rate:
        form, parts = "spm", (b"<S>", suffix, b"<P>", prefix, b"<M>", middle)
    else:
        form, parts = "psm", (b"<P>", prefix, b"<S>", suffix, b"<M>", middle)
    return units, form, a_points, b_points - a_points, b"".join(parts)


def transform(documents: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, block: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's text in its form: ``doc_id, n (units), form, prefix_chars, middle_chars, output``.

    ``rate`` percent of the texts are transformed, ``spm_rate`` percent of those with the suffix first. A text is left
    plain if it is empty (null counts as empty) or has one of the markers. Cuts depend on the seed and the id alone, so
    repeated rows come out alike and a null id is cut like an empty one. Other columns are not read; an empty table
    gives an empty result. Only a single very long text is held whole.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for part in slices(batches):
            flat, offsets = text_bytes(part.column(1))
            ends, points = marks(flat, offsets)
            data = flat.tobytes()
            found = []
            for doc_id, a, b in zip(part.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                tree = BlockTree(ends[a:b], points[a:b], block)
                found.append(arrange(data[a:b], tree, draws(doc_id, seed), rate, spm_rate))
            n, form, prefix, middle, output = zip(*found)
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return texts_of(documents, id_col, text_col).mapInArrow(run, FORMED)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from.

    An output that is not plain has each marker once: its text has none, and none can arise where parts meet, since a
    marker begins with its only ``<``.
    """
    return (
        F.when(form == "psm", F.regexp_replace(output, "(?s)^<P>(.*?)<S>(.*?)<M>(.*)$", "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, "(?s)^<S>(.*?)<P>(.*?)<M>(.*)$", "$2$3$1"))
        .otherwise(output)
    )
