"""Language labels for words by a linear-chain conditional random field, in numpy.

A word is described by hashed features: byte n-grams of the word between two edge marks (those that touch an edge are
its affixes), and the word itself (the lexicon). Learned weights give a score per language; learned transitions link
neighbouring words, so code-switched text gets a label per word. Forward-backward gives each word's probabilities;
a text's language is the one with the most expected words.

Words are runs of letters, in lower case. Long texts are cut into segments that are chained by their transfer
matrices, which is exact, so that all segments of a slice advance together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import SLICE_BYTES, slices, text_bytes, texts_of

GRAMS = (1, 2, 3, 4)
TABLE_BITS = 16
SEGMENT = 128
UNDETERMINED = "und"
# The bounded training sample: pieces per language, and characters of a piece. Pieces are drawn from whole texts.
SAMPLE_PER_LANGUAGE = 500
PIECE = 512
# Languages a field of this size can hold; with more, training fails rather than leave languages out.
MOST_LANGUAGES = 256
# Words of a training sequence, which is made of pieces.
SEQUENCE = 64
STEPS, BATCH, RATE = 250, 64, 0.05
# Share of training sequences that are spliced from texts of two languages.
SWITCHED = 0.5


def words_in(texts: pa.Array) -> pa.ListArray:
    """The words of each text."""
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    spaced = pc.utf8_trim(pc.replace_substring_regex(lowered, r"[^\p{L}]+", " "), " ")
    found = pc.split_pattern(spaced, " ")
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
    return found


def distinct(found: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the word number of each token, and the offsets of the texts; empty tokens are left out."""
    flat = found.flatten()
    offsets = found.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not there.all():
        offsets = np.concatenate([[0], np.cumsum(there)])[offsets]
        flat = flat.filter(pa.array(there))
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), offsets


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words end to end, and where each word's begin."""
    flat, offsets = text_bytes(words)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    marked = np.empty(len(flat) + 2 * n, np.uint64)
    at = offsets[:-1] + 2 * np.arange(n)
    inner = np.ones(len(marked), bool)
    inner[at] = False
    inner[at + sizes + 1] = False
    marked[at], marked[at + sizes + 1] = 2, 3
    marked[inner] = flat
    owner = np.repeat(np.arange(n), sizes + 2)
    numbers, owners = [], []
    gram = np.zeros(len(marked), np.uint64)
    for size in range(1, max(GRAMS) + 1):
        gram = gram[: len(marked) - size + 1] * np.uint64(0x9E3779B1) + marked[size - 1 :] + np.uint64(1)
        if size in GRAMS and len(gram):
            whole = owner[: len(gram)] == owner[size - 1 :]
            mixed = gram[whole] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(size)
            numbers.append((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - TABLE_BITS))
            owners.append(owner[: len(gram)][whole])
    weights = (np.arange(len(marked), dtype=np.uint64) - np.repeat(at.astype(np.uint64), sizes + 2)) * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1)
    lexicon = np.add.reduceat((marked + np.uint64(7)) * weights * np.uint64(0x9E3779B97F4A7C15), at)
    numbers.append(lexicon * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - TABLE_BITS))
    owners.append(np.arange(n))
    numbers, owners = np.concatenate(numbers).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return numbers[order], np.searchsorted(owners[order], np.arange(n))


class Field:
    """Weights of the field: ``emit`` (features x languages), ``move`` (from x to)."""

    def __init__(self, languages: list[str], emit: np.ndarray, move: np.ndarray):
        self.languages, self.emit, self.move = languages, emit, move

    def word_scores(self, words: pa.Array) -> np.ndarray:
        """Summed weights of each word's features, divided by the root of their number."""
        if not len(words):
            return np.empty((0, len(self.languages)), np.float32)
        numbers, begins = features(words)
        counts = np.diff(np.append(begins, len(numbers)))
        return np.add.reduceat(self.emit[numbers], begins, axis=0) / np.sqrt(counts)[:, None]

    def label(self, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for every token, by forward-backward; ``tokens`` holds word scores."""
        n_langs = len(self.languages)
        sizes = np.diff(offsets)
        segments = -(-sizes // SEGMENT)
        if not segments.sum():
            return np.empty((0, n_langs), np.float32)
        text = np.repeat(np.arange(len(sizes)), segments)
        number = np.arange(len(text)) - np.repeat(np.cumsum(segments) - segments, segments)
        begins = offsets[:-1][text] + number * SEGMENT
        lengths = np.minimum(offsets[1:][text] - begins, SEGMENT)
        move = np.exp(self.move - self.move.max()).astype(np.float32)
        heat = np.exp(tokens - tokens.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
        order = np.argsort(-lengths, kind="stable")
        begins, lengths, text, number = begins[order], lengths[order], text[order], number[order]
        alive = np.searchsorted(-lengths, -np.arange(1, SEGMENT + 1), side="right")
        steps = int(lengths[0])
        # Transfer matrix of each segment.
        transfer = np.broadcast_to(np.eye(n_langs, dtype=np.float32), (len(text), n_langs, n_langs)).copy()
        for t in range(steps if segments.max() > 1 else 0):
            m = alive[t]
            after = (transfer[:m].reshape(-1, n_langs) @ move).reshape(m, n_langs, n_langs) * heat[begins[:m] + t][:, None, :]
            transfer[:m] = after / after.max(axis=(1, 2), keepdims=True)
        # Chain the segments of each text, from the left and from the right.
        ahead = np.full((len(text), n_langs), 1 / n_langs, np.float32)
        behind = np.ones((len(text), n_langs), np.float32)
        place = np.empty(len(text), np.int64)
        place[np.cumsum(segments)[text] - segments[text] + number] = np.arange(len(text))
        first = np.cumsum(segments) - segments
        for k in range(1, int(segments.max())):
            has = segments > k
            here, last = place[first[has] + k], place[first[has] + k - 1]
            left = np.einsum("ni,nij->nj", ahead[last], transfer[last])
            ahead[here] = left / left.sum(axis=1, keepdims=True)
            here, later = place[first[has] + segments[has] - 1 - k], place[first[has] + segments[has] - k]
            right = np.einsum("nij,nj->ni", transfer[later], behind[later])
            behind[here] = right / right.sum(axis=1, keepdims=True)
        # Inside the segments.
        out = np.empty((len(tokens), n_langs), np.float32)
        for t in range(steps):
            m = alive[t]
            now = (ahead[:m] @ move) * heat[begins[:m] + t]
            ahead[:m] = now / now.sum(axis=1, keepdims=True)
            out[begins[:m] + t] = ahead[:m]
        for t in reversed(range(steps)):
            m = alive[t]
            at = begins[:m] + t
            both = out[at] * behind[:m]
            out[at] = both / both.sum(axis=1, keepdims=True)
            now = (behind[:m] * heat[at]) @ move.T
            behind[:m] = now / now.sum(axis=1, keepdims=True)
        return out


def likelihood_step(emit_scores: np.ndarray, move: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients by token scores and transitions of the negative log likelihood; sequences of one length."""
    n, length, k = emit_scores.shape
    heat = np.exp(emit_scores - emit_scores.max(axis=2, keepdims=True)) + 1e-12
    step = np.exp(move)
    ahead = np.empty_like(heat)
    now = np.full((n, k), 1 / k)
    for t in range(length):
        now = (now @ step) * heat[:, t]
        now /= now.sum(axis=1, keepdims=True)
        ahead[:, t] = now
    behind = np.ones((n, k))
    told, moved = np.empty_like(heat), np.zeros_like(move)
    for t in reversed(range(length)):
        told[:, t] = ahead[:, t] * behind
        told[:, t] /= told[:, t].sum(axis=1, keepdims=True)
        before = ahead[:, t - 1] if t else np.full((n, k), 1 / k)
        after = heat[:, t] * behind
        # Probabilities of neighbouring labels, added up over the sequences.
        moved += step * ((before / ((before @ step) * after).sum(axis=1, keepdims=True)).T @ after)
        behind = after @ step.T
        behind /= behind.sum(axis=1, keepdims=True)
    np.add.at(moved, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), -1)
    np.add.at(moved, (slice(None), gold[:, 0]), -1 / k)
    np.put_along_axis(told, gold[:, :, None], np.take_along_axis(told, gold[:, :, None], 2) - 1, 2)
    return told, moved


def train(texts: list[tuple[str, str]], seed: int = 7) -> Field | None:
    """A field from (language, words joined by spaces); None without any words."""
    texts = [(lang, words.split(" ")) for lang, words in texts if words]
    languages = sorted({lang for lang, _ in texts})
    if not languages:
        return None
    k = len(languages)
    by = [[w for lang, w in texts if lang == name] for name in languages]
    rng = np.random.default_rng(seed)
    vocabulary, index = pa.array(sorted({w for _, ws in texts for w in ws})), {}
    index = {w: i for i, w in enumerate(vocabulary.to_pylist())}
    numbers, begins = features(vocabulary)
    ends = np.append(begins[1:], len(numbers))
    emit, move = np.zeros((1 << TABLE_BITS, k)), np.zeros((k, k))
    state = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(move), np.zeros_like(move)]

    def sequence() -> tuple[list[str], list[int]]:
        words, gold = [], []
        while len(words) < SEQUENCE:
            lang = int(rng.integers(k))
            piece = by[lang][rng.integers(len(by[lang]))]
            most = SEQUENCE if rng.random() > SWITCHED else int(rng.integers(4, 33))
            piece = piece[:most]
            words += piece
            gold += [lang] * len(piece)
        return words[:SEQUENCE], gold[:SEQUENCE]

    for step in range(1, STEPS + 1):
        made = [sequence() for _ in range(BATCH)]
        tokens = np.array([index[w] for words, _ in made for w in words])
        gold = np.array([g for _, g in made])
        counts = ends[tokens] - begins[tokens]
        scale = 1 / np.sqrt(counts)
        total = np.cumsum(counts)
        spots = numbers[np.repeat(begins[tokens] - total + counts, counts) + np.arange(total[-1])]
        scores = np.add.reduceat(emit[spots], total - counts, axis=0) * scale[:, None]
        told, moved = likelihood_step(scores.reshape(BATCH, SEQUENCE, k), move, gold)
        share = told.reshape(-1, k) * scale[:, None] / BATCH
        grad = np.stack([np.bincount(spots, np.repeat(share[:, c], counts), 1 << TABLE_BITS) for c in range(k)], axis=1)
        rate = RATE * min(1, 3 * (1 - step / (STEPS + 1)))
        for weights, g, m, v in ((emit, grad + 1e-5 * emit, *state[:2]), (move, moved / BATCH + 1e-4 * move, *state[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            weights -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(languages, emit.astype(np.float32), move.astype(np.float32))


def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each piece, without those that a cut of the piece may have shortened."""
    for part in slices(batches, "piece"):
        out = []
        for words, head, tail in zip(words_in(part.column(1)).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist()):
            whole = words[0 if head else 1 : len(words) if tail else -1]
            # A piece inside one long word has no whole one.
            out.append(" ".join(whole or words))
        yield pa.record_batch([part.column(0), pa.array(out, pa.string())], names=["lang", "words"])


def pieces(known: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` pieces of each ``lang``, drawn by hash from all pieces of all whole texts: ``lang``,
    ``piece``, and whether it is the ``head`` or the ``tail`` of its text.

    Texts are cut into pieces of ``PIECE`` characters. The driver learns only the number of pieces of each language,
    which decides the language's rate. More than ``MOST_LANGUAGES`` languages are an error.
    """
    cut = known.withColumn("n", F.ceil(F.length("text") / PIECE).cast("int")).where("n > 0")
    sizes = cut.groupBy("lang").agg(F.sum("n").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return known.select("lang", F.col("text").alias("piece"), F.lit(True).alias("head"), F.lit(True).alias("tail")).limit(0)
    rates = F.create_map(*(F.lit(x) for r in sizes for x in (r.lang, min(1.0, per_language / r.n))))
    share = lambda i: F.pmod(F.xxhash64("doc_id", i), F.lit(1 << 20)) / float(1 << 20)
    rated = cut.withColumn("rate", rates[F.col("lang")])
    drawn = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: share(i) < F.col("rate"))
    chosen = rated.select("lang", "text", "n", F.explode(drawn).alias("i"))
    return chosen.select("lang", F.substring("text", F.col("i") * PIECE + 1, F.lit(PIECE)).alias("piece"), (F.col("i") == 0).alias("head"), (F.col("i") == F.col("n") - 1).alias("tail"))


def fit(documents: DataFrame, learn: Column, per_language: int = SAMPLE_PER_LANGUAGE) -> Field | None:
    """Train on a bounded sample of rows with a language for which ``learn`` (over ``doc_id``) holds.

    The driver receives about ``per_language`` pieces of ``PIECE`` characters of each language; every language of these
    rows is learned. None if no row has a language and words. More than ``MOST_LANGUAGES`` languages are an error, as
    weights of that many would not fit into the driver.
    """
    known = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = pieces(known, per_language).mapInArrow(worded, "lang string, words string").collect()
    return train(sorted((r.lang, r.words) for r in found))


def slice_bytes(field: Field | None) -> int:
    """Text bytes of a step, fewer with many languages, as a step's probabilities are words x languages."""
    return SLICE_BYTES * 8 // max(8, len(field.languages) if field else 0)


def predict(documents: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (share of expected words) of every whole text.

    ``und`` with score 0 for null, for texts without letters and for a field that could not be trained. Equal shares
    go to the first language in order. Repeated rows give a row each; a null id stays null.
    """
    held = documents.sparkSession.sparkContext.broadcast(field)
    step = slice_bytes(field)

    def run(batches):
        known = held.value
        for part in slices(batches, limit=step):
            names, shares = [], []
            words, tokens, offsets = distinct(words_in(part.column(1)))
            if known is not None:
                told = known.label(known.word_scores(words)[tokens], offsets)
                sums = np.concatenate([np.zeros((1, told.shape[1])), np.cumsum(told, axis=0, dtype=np.float64)])
                per_text = sums[offsets[1:]] - sums[offsets[:-1]]
            for k, size in enumerate(np.diff(offsets)):
                best = int(per_text[k].argmax()) if known is not None and size else None
                names.append(UNDETERMINED if best is None else known.languages[best])
                shares.append(0.0 if best is None else min(1.0, max(0.0, per_text[k][best] / size)))
            yield pa.record_batch([part.column(0), pa.array(names, pa.string()), pa.array(shares, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return texts_of(documents).mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def label_words(documents: DataFrame, field: Field) -> DataFrame:
    """Runs of words with one most likely language: ``doc_id``, ``first_word``, ``n_words``, ``lang``, ``score``.

    For code-switched text. Texts without words give no row.
    """
    held = documents.sparkSession.sparkContext.broadcast(field)
    step = slice_bytes(field)

    def run(batches):
        known = held.value
        for part in slices(batches, limit=step):
            words, tokens, offsets = distinct(words_in(part.column(1)))
            told = known.label(known.word_scores(words)[tokens], offsets)
            best = told.argmax(axis=1)
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            begins = np.flatnonzero(np.r_[True, (np.diff(best) != 0) | (np.diff(text) != 0)]) if len(best) else np.empty(0, np.int64)
            sizes = np.diff(np.append(begins, len(best)))
            sure = np.add.reduceat(told.max(axis=1), begins) / sizes if len(begins) else np.empty(0)
            ids = part.column(0).take(pa.array(text[begins]))
            names = [known.languages[b] for b in best[begins]]
            yield pa.record_batch([ids, pa.array(begins - offsets[text[begins]], pa.int64()), pa.array(sizes, pa.int64()), pa.array(names, pa.string()), pa.array(sure, pa.float64())], names=["doc_id", "first_word", "n_words", "lang", "score"])

    return texts_of(documents).mapInArrow(run, "doc_id bigint, first_word bigint, n_words bigint, lang string, score double")
