"""Byte-level BPE by recursive DuckDB queries, one set of queries inside each Spark task.

A text is split by the public pattern; the distinct matches of a slice of texts ("words") go to DuckDB. There each
position of a word is a row that joins the table of merges; the leftmost pair of the smallest rank of every word is
contracted, again and again, until no word has a pair left. Decoding is an ordered aggregation over token rows.
A word that is itself in the vocabulary is that token, as in the tiktoken library.

A step lays out every token of its words, and a word takes about as many steps as it has bytes. So long words come in
pieces, which are contracted by the same query and then joined: tokens side by side are the word's own if the two bytes
strings of every two neighbours, contracted together, give the two again. Where two pieces meet and that fails, a few
tokens on both sides are contracted anew, more of them each time, until it holds.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from eventlake.llm.common import slices, texts_of

# Text bytes that are coded at a time; the rows of their tokens take many times as much.
CODED_BYTES = 1024**2
# Words kept by a Python worker with their ids; beyond that the store starts anew.
STORED_WORDS = 400_000
# Words of one recursive query, which bounds its memory.
QUERY_WORDS = 20_000
# Bytes of one recursive query, which bounds its memory as well, and of one piece of a word.
QUERY_BYTES = 400_000
PIECE = 64
# Tokens on both sides of a seam that are contracted anew at first.
SEAM = 4
ENCODED = "doc_id bigint, n_tokens bigint, ids binary, decoded binary"

# One row per word and step; its tokens are laid out as position rows for the join. One thread keeps row order.
CONTRACT = """
WITH RECURSIVE s(w, toks, best) AS (
  SELECT w, toks, 0::BIGINT FROM words
  UNION ALL
  SELECT s.w,
    CASE WHEN b.best IS NULL THEN s.toks
         ELSE list_concat(s.toks[:(b.best & 4294967295) - 1], [(b.best >> 32)::INTEGER], s.toks[(b.best & 4294967295) + 2:]) END,
    b.best
  FROM s LEFT JOIN (
    SELECT w, min((merged::BIGINT << 32) | i) AS best
    FROM (
      SELECT w, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r, unnest(range(1, len(toks))) AS i
      FROM s WHERE best IS NOT NULL
    ) JOIN merges ON pair = l::BIGINT * 65536 + r
    GROUP BY w
  ) b ON s.w = b.w
  WHERE s.best IS NOT NULL
)
SELECT toks FROM s WHERE best IS NULL ORDER BY w
"""

DECODE = """
SELECT doc, string_agg(piece, '') AS text
FROM (SELECT doc, pos, piece FROM tokens JOIN vocabulary USING (id) ORDER BY doc, pos)
GROUP BY doc
"""


def vocabulary_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def load_ranks(path: str | None = None) -> dict[bytes, int]:
    with open(vocabulary_path(path), "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def pattern() -> regex.Pattern:
    import public_tokenizers

    return regex.compile(public_tokenizers.PATTERN)


@lru_cache(maxsize=2)
def encoding(path: str | None = None):
    """The tiktoken encoding over the same ranks, for short segments and for tests."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})


class Tokens:
    """The tables of one vocabulary, for an in-memory DuckDB while it is open, with the words met so far."""

    def __init__(self, path: str | None = None):
        ranks = load_ranks(path)
        pieces = [(left, right, rank) for token, rank in ranks.items() for left, right in ((ranks.get(token[:k]), ranks.get(token[k:])) for k in range(1, len(token))) if left is not None and right is not None]
        left, right, rank = np.array(pieces, dtype=np.int64).T
        self.ranks = ranks
        self.text = {rank: token for token, rank in ranks.items()}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.tables = {
            "merges": pa.table({"pair": left * 65536 + right, "merged": rank.astype(np.int32)}),
            "vocabulary": pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "piece": [t.decode("latin-1") for t in ranks]}),
        }
        self.opened = None
        self.clear()

    @property
    def con(self):
        """The database, opened when it is first needed."""
        if self.opened is None:
            import duckdb

            self.opened = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
            for name, given in self.tables.items():
                self.opened.register("given", given)
                self.opened.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
                self.opened.unregister("given")
        return self.opened

    def close(self) -> None:
        """Give back the database's memory, which it keeps for its next queries; the next use opens it again."""
        if self.opened is not None:
            self.opened.close()
            self.opened = None

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    def contract(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, by queries over a bounded number of words and bytes."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        out: list[np.ndarray] = []
        start = 0
        while start < len(words):
            inside = int(np.searchsorted(np.cumsum(sizes[start : start + QUERY_WORDS]), QUERY_BYTES, side="right"))
            stop = start + max(1, inside)
            offsets = np.concatenate([[0], np.cumsum(sizes[start:stop])]).astype(np.int32)
            tokens = self.bytes[np.frombuffer(b"".join(words[start:stop]), np.uint8)]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens))
            self.con.register("words", pa.table({"w": pa.array(np.arange(stop - start, dtype=np.int32)), "toks": lists}))
            found = self.con.sql(CONTRACT).to_arrow_table().column("toks").combine_chunks()
            self.con.unregister("words")
            out += np.split(found.flatten().to_numpy(), found.offsets.to_numpy()[1:-1] - found.offsets.to_numpy()[0])
            start = stop
        return out

    def contract_once(self, words: list[bytes], known: dict[bytes, np.ndarray]) -> list[np.ndarray]:
        """Ids of each word; a word that occurs several times is contracted once."""
        unseen = list({w: None for w in words if w not in known})
        for word in unseen:
            if word in self.ranks:
                known[word] = np.array([self.ranks[word]], np.int32)
        unseen = [w for w in unseen if w not in known]
        known.update(zip(unseen, self.contract(unseen)))
        return [known[w] for w in words]

    def contract_pieces(self, word: bytes) -> np.ndarray:
        """Ids of a long word: of its pieces, with the seams between them mended."""
        known: dict[bytes, np.ndarray] = {}
        parts = self.contract_once([word[i : i + PIECE] for i in range(0, len(word), PIECE)], known)
        holds = [False] * (len(parts) - 1)  # the seam between part k and the next one
        width = SEAM
        while not all(holds):
            seams = [k for k, good in enumerate(holds) if not good]
            pairs = [(int(parts[k][-1]), int(parts[k + 1][0])) for k in seams]
            joined = self.contract_once([self.text[x] + self.text[y] for x, y in pairs], known)
            torn = [k for k, pair, ids in zip(seams, pairs, joined) if tuple(ids.tolist()) != pair]
            # Of torn seams side by side the second waits, so that no part changes at both ends at once.
            now: list[int] = []
            for k in torn:
                if not now or now[-1] != k - 1:
                    now.append(k)
            around = [b"".join(self.text[t] for t in (*parts[k][-width:].tolist(), *parts[k + 1][:width].tolist())) for k in now]
            mended = dict(zip(now, self.contract_once(around, known)))
            still_torn = set(torn)
            out, good, gone = [parts[0]], [], False
            for k, right in enumerate(parts[1:]):
                if k not in mended:
                    good.append(k not in still_torn and not gone)
                    out.append(right)
                    gone = False
                    continue
                before, after = out.pop()[:-width], right[width:]
                if len(before):
                    out.append(before)
                    good.append(False)
                elif good:  # the part before has another neighbour now
                    good[-1] = False
                out.append(mended[k])
                gone = not len(after)
                if len(after):
                    out.append(after)
                    good.append(False)
            parts, holds = out, good
            width *= 2
        return np.concatenate(parts)

    def learn(self, words: list[str]) -> None:
        """Store the ids of words not met before."""
        coded = [w.encode("utf-8") for w in words]
        known = [self.ranks.get(w) for w in coded]
        order = [i for i, k in enumerate(known) if k is not None]
        parts = [np.array([known[i]], np.int32) for i in order]
        short = [i for i, k in enumerate(known) if k is None and len(coded[i]) <= PIECE]
        parts += self.contract([coded[i] for i in short])
        long = [i for i, k in enumerate(known) if k is None and len(coded[i]) > PIECE]
        parts += [self.contract_pieces(coded[i]) for i in long]
        order += short + long
        new = np.array([len(p) for p in parts], np.int64)
        self.index.update(zip((words[i] for i in order), range(len(self.sizes), len(self.sizes) + len(order))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(new) - new])
        self.sizes = np.concatenate([self.sizes, new])
        self.flat = np.concatenate([self.flat, *parts]).astype(np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and the offsets of the texts in them."""
        find = pattern().findall
        split = [find(text) for text in texts]
        words = [w for found in split for w in found]
        if len(self.index) > STORED_WORDS:
            self.clear()
        unseen = list(set(words).difference(self.index))
        if unseen:
            self.learn(unseen)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])]
        return ids, bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        n = len(bounds) - 1
        self.con.register("tokens", pa.table({"doc": np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds)), "pos": np.arange(len(ids), dtype=np.int32), "id": ids.astype(np.int32)}))
        texts = dict(self.con.sql(DECODE).fetchall())
        self.con.unregister("tokens")
        return [texts.get(doc, "").encode("latin-1") for doc in range(n)]


_tokens: dict[str | None, Tokens] = {}


def tokens_of(path: str | None = None) -> Tokens:
    """One set of tables per Python worker and vocabulary."""
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype="<u4").tolist()


def coded(batches: Iterator[pa.RecordBatch], vocabulary: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows doc_id, text with their ids and decoded bytes.

    A Python worker outlives its tasks and stands beside the executor in other stages, so the database goes with the task.
    """
    coder = tokens_of(vocabulary)
    try:
        for part in slices(batches, limit=CODED_BYTES):
            ids, bounds = coder.encode(part.column(1).to_pylist())
            packed = ids.astype("<u4").tobytes()
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([packed[4 * a : 4 * b] for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                    pa.array(coder.decode(ids, bounds), pa.binary()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )
    finally:
        coder.close()


def encode_decode(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per document its ids (little-endian unsigned 32-bit integers end to end), their number, and the decoded bytes.

    A null or empty text has no ids and decodes to nothing. Every row gives one row; a null id stays null.
    """
    return texts_of(documents).mapInArrow(lambda batches: coded(batches, vocabulary), ENCODED)
