"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, one scan per document.

Texts are normalised to lower-case words with single spaces. Every window of ten words of an item is a pattern of
the automaton; a word of a document inside any occurrence of a window is hit. Hit words are mapped back to the
original text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import slices, texts_of

WINDOW_WORDS = 10
# Items are held in the automaton by blocks of at most this many bytes of text; a larger set makes several blocks,
# which every document passes one after the other.
BLOCK_BYTES = 8 * 1024**2
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# ASCII letters to lower case, digits and bytes of non-ASCII characters as they are, all else to space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, "
    "hits array<struct<first_word:int,last_word:int,start:int,stop:int>>"
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLDED).split()


def windows_of(text: str, width: int = WINDOW_WORDS) -> set[str]:
    """The patterns of one item: windows with a space at both ends, bytes as Latin-1 characters."""
    words = words_of(text)
    if not words:
        return set()
    spans = [words[i : i + width] for i in range(max(1, len(words) - width + 1))]
    return {(b" " + b" ".join(span) + b" ").decode("latin-1") for span in spans}


def automaton_of(items: list[tuple[str, str]], width: int = WINDOW_WORDS):
    """An automaton whose patterns carry (length in words, numbers of the items); None without any pattern."""
    import ahocorasick

    owners: dict[str, list[int]] = {}
    for number, (_, text) in enumerate(items):
        for window in windows_of(text, width):
            owners.setdefault(window, []).append(number)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for window, numbers in owners.items():
        automaton.add_word(window, (len(window), window.count(" ") - 1, tuple(numbers)))
    automaton.make_automaton()
    return automaton


_built: dict[str, object] = {}


def _automaton(items: list[tuple[str, str]], width: int):
    """Built once per Python worker and block."""
    key = hashlib.sha256(repr((width, items)).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _built:
        _built.clear()
        _built[key] = automaton_of(items, width)
    return _built[key]


def hits_in(text: str, automaton, n_items: int) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Words of the text, the merged runs (first, last) of hit words, the numbers of the items that occur."""
    words = words_of(text)
    if not words or automaton is None:
        return len(words), [], set()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts, runs, found = None, [], set()
    for end, (length, count, numbers) in automaton.iter(line):
        if starts is None:
            starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        first = int(np.searchsorted(starts, end - length + 1))
        runs.append((first, first + count - 1))
        found.update(numbers)
    return len(words), merged(runs), found


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """Items streamed to the driver one partition at a time, in blocks of bounded size. Null texts have no words."""
    block, size = [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").alias("t")).where("t is not null").toLocalIterator():
        bytes_here = len(row.t)
        if block and size + bytes_here > limit:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += bytes_here
    yield block


def scan_block(df: DataFrame, items: list[tuple[str, str]], width: int) -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(items)

    def scan(batches):
        known = held.value
        automaton = _automaton(known, width)
        for part in slices(batches):
            out = []
            for doc_id, text, runs, ids in zip(*(part.column(k).to_pylist() for k in range(4))):
                n_words, new, found = hits_in(text, automaton, len(known))
                if new:
                    runs = [n for run in merged([*zip(runs[::2], runs[1::2]), *new]) for n in run]
                    ids = sorted({*ids, *(known[k][0] for k in found)})
                out.append((doc_id, text, runs, ids, n_words))
            columns = list(zip(*out))
            yield pa.record_batch(
                [pa.array(columns[0], pa.int64()), part.column(1), pa.array(columns[2], pa.list_(pa.int32())), pa.array(columns[3], pa.list_(pa.string())), pa.array(columns[4], pa.int64())],
                names=["doc_id", "text", "runs", "items", "n_words"],
            )

    return df.select("doc_id", "text", "runs", "items").mapInArrow(scan, "doc_id bigint, text string, runs array<int>, items array<string>, n_words bigint")


def original_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of hit words with their code points in the original text (end exclusive)."""
    for part in slices(batches):
        doc_ids, texts, runs, items, n_words = (part.column(k).to_pylist() for k in range(5))
        hits, counts = [], []
        for text, flat in zip(texts, runs):
            pairs = list(zip(flat[::2], flat[1::2]))
            counts.append(sum(last - first + 1 for first, last in pairs))
            places = [m.span() for m in WORD.finditer(text.lower() if text.isascii() else text.translate(ASCII_LOWER))] if pairs else []
            hits.append([{"first_word": a, "last_word": b, "start": places[a][0], "stop": places[b][1]} for a, b in pairs])
        kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("first_word", "last_word", "start", "stop")]))
        yield pa.record_batch(
            [pa.array(doc_ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(counts, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(hits, kind)],
            names=["doc_id", "n_words", "n_hit", "items", "hits"],
        )


ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, hit words, the items with occurring windows, and the hit runs in the original text.

    A null or empty text has no words and no hits. Items without words match nothing; an item of fewer words than
    the window is one window as a whole. Rows that share an ``item_id`` count as one item. Repeated documents give
    a row each. No benchmark rows: nothing is hit. A null id stays null.
    """
    empty = F.array().cast("array<int>"), F.array().cast("array<string>")
    df = texts_of(documents).select("doc_id", "text", empty[0].alias("runs"), empty[1].alias("items"))
    for block in item_blocks(benchmark, block_bytes):
        df = scan_block(df, block, width)
    return df.select("doc_id", "text", "runs", "items", "n_words").mapInArrow(original_hits, SCHEMA)


def clean_documents(documents: DataFrame, benchmark: DataFrame, least_hit: int = 1) -> DataFrame:
    """The documents with fewer than ``least_hit`` hit words, all columns as they were.

    Each row is decided by its own text, also where ids are null or repeated: rows are told apart by a hash of both.
    """
    own = F.xxhash64(documents["doc_id"].cast("string"), F.coalesce(documents["text"].cast("string"), F.lit("")))
    found = contamination(documents.select(own.alias("doc_id"), "text"), benchmark)
    bad = found.where(F.col("n_hit") >= least_hit).select("doc_id").distinct()
    return documents.join(bad, own == bad["doc_id"], "left_anti")
