"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine on a block-max inverted index.

Terms are words and the first four to seven letters of words. The index holds the terms whose document frequency
differs significantly between toxic and other examples, and all other words as one term "other word", so that how much
of a text the indexed terms make up counts. Examples are numbered, and the postings of a term lie in blocks of examples
with the largest weight of the block. A query scores the blocks with the highest bounds and then those that can still
reach its k-th best example, so the result is exact. Neighbours vote with their similarity; a logistic curve fitted on
left-out examples calibrates the vote.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed, sampled, slices, texts_of

# Bounds of the sample of examples, of the terms and of the rows that fit the calibration.
EXAMPLES_PER_CLASS = 3000
MOST_TERMS = 4096
CALIBRATION_ROWS = 3000
# A term needs this log-likelihood ratio between the classes.
LEAST_RATIO = 24.0
NEIGHBOURS = 15
BLOCK = 64
# Blocks that a search scores before it compares the bounds of the others with its k-th best.
FIRST_BLOCKS = 8
# The term that stands for every word without an indexed term; it is always term 0.
OTHER = "other word"
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7)
EVIDENCE = "array<struct<doc_id:bigint,similarity:double,toxic:int>>"


def spelled(word: str) -> list[str]:
    """The terms of a word."""
    return [word, *(f"{word[:n]}_" for n in PREFIXES if len(word) > n)]


def terms_of(words: Counter, keep: dict[str, int], seen: dict[str, tuple]) -> dict[int, int]:
    """Counts of numbered terms from word counts; ``seen`` remembers the terms of a word. Other words are term 0."""
    if len(seen) > 400_000:
        seen.clear()
    out: dict[int, int] = {}
    other = 0
    for word, count in words.items():
        known = seen.get(word)
        if known is None:
            known = seen[word] = tuple(keep[t] for t in spelled(word) if t in keep)
        if known:
            for term in known:
                out[term] = out.get(term, 0) + count
        else:
            other += count
    if other:
        out[0] = other
    return out


def words_in(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def ranked(found: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    return sorted(found, key=lambda x: (-round(x[0], 9), x[1]))[:k]


class Index:
    """Block-max inverted index over unit vectors of examples."""

    def __init__(self, terms: list[str], idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: list[dict[int, float]]):
        self.terms = {t: i for i, t in enumerate(terms)}
        self.idf, self.ids, self.labels = idf, ids, labels
        self.blocks = max(1, -(-len(vectors) // BLOCK))
        lists: list[list[tuple[int, float]]] = [[] for _ in terms]
        for number, vector in enumerate(vectors):
            for term, weight in vector.items():
                lists[term].append((number, weight))
        self.highest = np.zeros((len(terms), self.blocks))
        self.starts = np.zeros((len(terms), self.blocks + 1), np.int64)
        places, weights, base = [], [], 0
        for term, postings in enumerate(lists):
            numbers = np.array([n for n, _ in postings], np.int64)
            values = np.array([w for _, w in postings])
            np.maximum.at(self.highest[term], numbers // BLOCK, values)
            self.starts[term] = base + np.searchsorted(numbers, np.arange(self.blocks + 1) * BLOCK)
            places.append(numbers)
            weights.append(values)
            base += len(postings)
        self.places = np.concatenate(places) if places else np.empty(0, np.int64)
        self.weights = np.concatenate(weights) if weights else np.empty(0)
        self.curve = (4.0, -2.0)

    def weigh(self, counts: dict[int, int]) -> dict[int, float]:
        """The unit TF-IDF vector of term counts."""
        raw = {t: (1 + math.log(c)) * self.idf[t] for t, c in counts.items()}
        size = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / size for t, w in raw.items()} if size else {}

    def nearest(self, query: dict[int, float], k: int = NEIGHBOURS, without: int = -1) -> list[tuple[float, int]]:
        """The k most similar examples (similarity, number) with similarity above 0; ties by number."""
        if not query:
            return []
        terms, weights = np.fromiter(query, np.int64), np.fromiter(query.values(), float)
        bounds = np.round(weights @ self.highest[terms], 9)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        best = self.best_in(order[:FIRST_BLOCKS], terms, weights, k, without)
        rest = order[FIRST_BLOCKS:]
        if len(best) == k:
            # A block with the bound of the k-th can only win the tie with smaller numbers.
            least, number = round(best[-1][0], 9), best[-1][1]
            rest = rest[(bounds[rest] > least) | ((bounds[rest] == least) & (rest * BLOCK < number))]
        if len(rest):
            best = ranked([*best, *self.best_in(rest, terms, weights, k, without)], k)
        return best

    def best_in(self, blocks: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, without: int) -> list[tuple[float, int]]:
        """The k most similar examples in some blocks, from the postings of the query's terms in them."""
        blocks = np.sort(blocks)
        begins, ends = self.starts[terms][:, blocks].ravel(), self.starts[terms][:, blocks + 1].ravel()
        sizes = ends - begins
        total = np.cumsum(sizes)
        if not len(total) or not total[-1]:
            return []
        at = np.repeat(begins - total + sizes, sizes) + np.arange(total[-1])
        scores = np.bincount(self.places[at], self.weights[at] * np.repeat(np.repeat(weights, len(blocks)), sizes), self.blocks * BLOCK)
        if without >= 0:
            scores[without] = 0
        found = np.flatnonzero(scores > 0)
        if len(found) > k:
            rounded = np.round(scores[found], 9)
            found = found[rounded >= np.partition(rounded, len(found) - k)[len(found) - k]]
            found = found[np.lexsort((found, -np.round(scores[found], 9)))[:k]]
        return ranked([(float(scores[i]), int(i)) for i in found], k)

    def vote(self, near: list[tuple[float, int]]) -> float:
        return sum(s for s, n in near if self.labels[n]) / sum(s for s, _ in near) if near else 0.0

    def calibrated(self, vote: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.curve[0] * vote + self.curve[1]))))


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies by class of the examples of a task; rows of bounded batches."""
    counts = (Counter(), Counter())

    def told():
        names = list(counts[0].keys() | counts[1].keys())
        return pa.record_batch([pa.array(names, pa.string()), pa.array([counts[1][t] for t in names], pa.int64()), pa.array([counts[0][t] for t in names], pa.int64())], names=["term", "toxic", "other"])

    for part in slices(batches):
        for label, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
            counts[label].update({t for word in words_in(text) for t in spelled(word)})
        if len(counts[0]) + len(counts[1]) > 500_000:
            yield told()
            counts[0].clear()
            counts[1].clear()
    yield told()


def calibrate(index: Index, examples: list[dict[int, int]]) -> tuple[float, float]:
    """Logistic curve over the votes of examples, each left out of its own search (Newton steps, slight ridge)."""
    step = max(1, len(examples) // CALIBRATION_ROWS)
    votes = np.array([index.vote(index.nearest(index.weigh(examples[i]), without=i)) for i in range(0, len(examples), step)])
    labels = index.labels[::step]
    if not len(votes):
        return 0.0, -3.0
    x, w = np.stack([votes, np.ones_like(votes)], axis=1), np.array([1.0, -1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(hess, x.T @ (p - labels) + 1e-2 * w)
    return float(w[0]), float(w[1])


def fit(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", per_class: int = EXAMPLES_PER_CLASS) -> Index:
    """Index of a bounded sample of labelled rows for which ``learn`` (over ``doc_id``) holds.

    Equal texts of one label count once. Term frequencies are added up by Spark over the sample; the driver receives
    at most ``MOST_TERMS`` terms and the sample's counts of those. Null labels and labels without document are left out.
    """
    spark = documents.sparkSession
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where(learn & F.col("label").isin(0, 1))
    ids = F.broadcast(sampled(known, "label", per_class))
    rows = texts_of(documents).join(ids, "doc_id").groupBy("label", F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    rows = checkpointed(rows.select("doc_id", "label", "text"))
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        index = Index([], np.empty(0), np.empty(0, np.int64), np.empty(0), [])
        index.curve = (0.0, 3.0 if n_toxic else -3.0)
        return index
    found = rows.mapInArrow(count_terms, "term string, toxic bigint, other bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # Only terms that are that frequent can reach the ratio.
    found = found.where(F.col("toxic") / n_toxic != F.col("other") / n_other).where(F.col("toxic") + F.col("other") >= 4)
    p, n = F.col("toxic"), F.col("other")

    def part(x, size, share):
        xs = x * F.log(F.greatest(share, F.lit(1e-12)))
        return xs + (size - x) * F.log(F.greatest(1 - share, F.lit(1e-12)))

    both = (p + n) / (n_toxic + n_other)
    worth = 2 * (part(p, n_toxic, p / n_toxic) + part(n, n_other, n / n_other) - part(p, n_toxic, both) - part(n, n_other, both))
    top = found.withColumn("worth", worth).where(F.col("worth") >= LEAST_RATIO).orderBy(F.desc("worth"), "term").limit(MOST_TERMS).collect()
    top = [r for r in top if r.toxic / n_toxic > r.other / n_other or r.worth >= 4 * LEAST_RATIO]
    terms = [OTHER, *(r.term for r in top)]
    idf = np.array([math.log(2), *(math.log(1 + (n_toxic + n_other) / (1 + r.toxic + r.other)) for r in top)])
    held = spark.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def vectors(batches):
        seen: dict = {}
        for batch in slices(batches):
            made = [terms_of(words_in(t), held.value, seen) for t in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([list(m.keys()) for m in made], pa.list_(pa.int32())), pa.array([list(m.values()) for m in made], pa.list_(pa.int32()))],
                names=["doc_id", "label", "terms", "counts"],
            )

    examples = rows.mapInArrow(vectors, "doc_id bigint, label int, terms array<int>, counts array<int>").collect()
    examples.sort(key=lambda r: (r.label, r.terms, r.doc_id))
    counted = [dict(zip(r.terms, r.counts)) for r in examples]
    index = Index(terms, idf, np.array([r.doc_id for r in examples], np.int64), np.array([r.label for r in examples], float), [])
    index = Index(terms, idf, index.ids, index.labels, [index.weigh(c) for c in counted])
    index.curve = calibrate(index, counted)
    return index


def score(documents: DataFrame, index: Index, k: int = NEIGHBOURS) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``evidence`` (nearest examples) of every whole text.

    A null or empty text, like any text without a word, has no neighbours and the score of an empty vote.
    Repeated rows give a row each; a null id stays null. No other column is read.
    """
    held = documents.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        known, seen = held.value, {}
        plain = known.nearest({0: 1.0}, k) if known.terms else []
        for part in slices(batches):
            marks, proof = [], []
            for text in part.column(1).to_pylist():
                query = known.weigh(terms_of(words_in(text), known.terms, seen)) if known.terms else {}
                near = plain if query.keys() == {0} else known.nearest(query, k)
                marks.append(known.calibrated(known.vote(near)))
                proof.append([{"doc_id": int(known.ids[n]), "similarity": s, "toxic": int(known.labels[n])} for s, n in near])
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
            yield pa.record_batch([part.column(0), pa.array(marks, pa.float64()), pa.array(proof, kind)], names=["doc_id", "score", "evidence"])

    return texts_of(documents).mapInArrow(run, f"doc_id bigint, score double, evidence {EVIDENCE}")
