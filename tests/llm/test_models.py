"""The learned operators: held-out accuracy, exactness of their core, odd inputs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake.llm import language, quality, queries, toxicity
from eventlake.llm.common import fold, sampled, text_bytes
from tests.llm.frames import no_documents, odd_documents

DATA = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def judged(spark, query, label, folds):
    got = query(spark, DATA)
    truth = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col(label).alias("truth")) if label != "lang" else spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    frame = got.join(truth, "doc_id").toPandas()
    assert got.count() == 1000
    return frame[frame["held_out"]]


def test_quality_on_held_out_rows(spark):
    frame = judged(spark, queries.op6_quality_classifier, "quality", 4)
    assert (frame["predicted"] == frame["truth"]).mean() > 0.9
    assert frame["score"].between(0, 1).all()


def test_toxicity_on_held_out_rows(spark):
    frame = judged(spark, queries.op1_toxicity, "toxic", 5)
    # A few dozen toxic examples only; accuracy on larger tables is in the README.
    assert (frame["predicted"] == frame["truth"]).mean() > 0.88
    assert frame["score"].between(0, 1).all()


def test_language_on_held_out_rows(spark):
    frame = judged(spark, queries.op2_language_id, "lang", 5)
    assert (frame["lang_pred"] == frame["truth"]).mean() > 0.97


# -- quality ---------------------------------------------------------------------------------------------------


def test_chunks_cover_every_byte():
    rng = random.Random(1)
    sizes = [0, 1, 511, 512, 513, 960, 961, 5000, *(rng.randint(0, 4000) for _ in range(20))]
    flat = np.arange(sum(sizes), dtype=np.int64).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    seen = {}
    for chunks, owners in quality.blocks(flat, offsets):
        for chunk, owner in zip(chunks, owners):
            seen.setdefault(int(owner), []).append(chunk)
    for k, size in enumerate(sizes):
        starts = quality.chunk_starts(size)
        assert len(seen[k]) == len(starts)
        covered = {s + i for s in starts for i in range(quality.CHUNK) if s + i < size}
        assert covered == set(range(size))
        for start, chunk in zip(starts, seen[k]):
            own = flat[offsets[k] + start : min(offsets[k] + start + quality.CHUNK, offsets[k + 1])]
            assert (chunk[: len(own)] == own).all() and (chunk[len(own) :] == quality.PAD).all()


def test_scores_do_not_depend_on_the_slice():
    model = quality.start_model()
    texts = ["short", "", "word " * 300, "x" * 3000, "end"]
    together = quality.scores(*text_bytes(pa.array(texts)), model)
    alone = [quality.scores(*text_bytes(pa.array([t])), model)[0] for t in texts]
    assert np.allclose(together, alone)


def test_gradients_match_differences():
    model = {k: v.astype(np.float64) for k, v in quality.start_model(3).items()}
    flat, offsets = text_bytes(pa.array(["abcab " * 200, "xyz! " * 30]))
    chunks, owners = quality.cut(flat, offsets)
    target, weight = np.array([1.0, 0.0]), np.array([0.5, 0.5])

    def loss(m):
        units = quality.hidden(quality.convolve(chunks, m)[0], m)
        p = quality.sigmoid(quality.top_by_owner(units, owners) @ m["out"] + m["out_bias"])
        return -(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum()

    grad = quality.gradients(chunks, owners, target, weight, model)
    rng = np.random.default_rng(0)
    for name in ("out", "mix", "filters", "filter_bias", "mix_bias"):
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in model[name].shape)
            moved = {k: v.copy() for k, v in model.items()}
            moved[name][at] += 1e-6
            assert (loss(moved) - loss(model)) / 1e-6 == pytest.approx(grad[name][at], abs=1e-3)


def test_quality_odd_inputs(spark):
    odd = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (5, None, None), (None, 1, 1), (99, 0, 1)], LABELS)
    model = quality.fit(odd, labels, F.lit(True))
    got = quality.score(odd, model).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    constant = quality.fit(odd, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(odd, constant).collect()} == {0.5}
    assert quality.score(no_documents(spark), model).count() == 0
    kept = quality.keep_good(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.count() == 10


# -- toxicity --------------------------------------------------------------------------------------------------


def test_nearest_examples_are_exact():
    rng = random.Random(1)
    size, terms = 900, 50
    counts = [{rng.randrange(terms): rng.randint(1, 4) for _ in range(rng.randint(1, 8))} for _ in range(size)]
    counts += counts[:40]
    idf = np.random.default_rng(0).uniform(0.3, 4, terms)
    blank = toxicity.Index(list(map(str, range(terms))), idf, np.arange(len(counts)), np.zeros(len(counts)), [])
    index = toxicity.Index(list(map(str, range(terms))), idf, np.arange(len(counts)), np.zeros(len(counts)), [blank.weigh(c) for c in counts])
    dense = np.zeros((len(counts), terms))
    for number, count in enumerate(counts):
        for term, weight in blank.weigh(count).items():
            dense[number, term] = weight
    for k in range(200):
        query = index.weigh(counts[k] if k % 2 else {rng.randrange(terms): 1 for _ in range(rng.randint(1, 5))})
        scores = dense @ np.array([query.get(t, 0.0) for t in range(terms)])
        want = sorted((-round(s, 9), n) for n, s in enumerate(scores) if s > 1e-15 and n != k)[:15]
        assert [n for _, n in index.nearest(query, without=k)] == [n for _, n in want]


def test_toxicity_odd_inputs(spark):
    odd = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (99, 0, 1)], LABELS)
    for known in (labels, labels.limit(0)):
        index = toxicity.fit(odd, known, F.lit(True))
        got = toxicity.score(odd, index).collect()
        assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(no_documents(spark), index).count() == 0


def test_sample_is_bounded_by_class(spark):
    labelled = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 50 = 0 AS int) AS label")
    counts = {r.label: r["count"] for r in sampled(labelled, "label", 200).groupBy("label").count().collect()}
    assert counts[1] == 100 and 120 < counts[0] < 280


# -- language --------------------------------------------------------------------------------------------------


def small_field():
    rng = random.Random(2)
    texts = [("aa", " ".join("".join(rng.choices("abcde", k=5)) for _ in range(40))) for _ in range(30)]
    texts += [("zz", " ".join("".join(rng.choices("vwxyz", k=5)) for _ in range(40))) for _ in range(30)]
    return language.train(texts)


def test_segments_are_chained_exactly():
    field = language.Field(["a", "b", "c"], np.zeros((1, 3), np.float32), np.random.default_rng(1).normal(0, 1, (3, 3)).astype(np.float32))
    sizes = [0, 1, 127, 128, 129, 700, 3]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    tokens = np.random.default_rng(2).normal(0, 2, (offsets[-1], 3))
    told = field.label(tokens, offsets)
    step = np.exp(field.move.astype(float))
    for a, b in zip(offsets[:-1], offsets[1:]):
        heat, ahead, behind = np.exp(tokens[a:b]), np.full(3, 1 / 3), np.ones(3)
        left = []
        for t in range(b - a):
            ahead = (ahead @ step) * heat[t]
            ahead /= ahead.sum()
            left.append(ahead)
        for t in reversed(range(b - a)):
            want = left[t] * behind
            assert np.allclose(told[a + t], want / want.sum(), atol=1e-5)
            behind = step @ (heat[t] * behind)
            behind /= behind.sum()


def test_likelihood_gradient():
    rng = np.random.default_rng(4)
    scores, move, gold = rng.normal(0, 1, (2, 4, 3)), rng.normal(0, 1, (3, 3)), rng.integers(0, 3, (2, 4))

    def loss(s, m):
        total = 0.0
        for k in range(2):
            paths = np.full(3, -np.log(3))
            gold_score = -np.log(3)
            for t in range(4):
                paths = np.log(np.exp(paths) @ np.exp(m)) + s[k, t]
            one = np.log(np.exp(m).sum(axis=0) / 3)[gold[k, 0]] + s[k, 0, gold[k, 0]]
            for t in range(1, 4):
                one += m[gold[k, t - 1], gold[k, t]] + s[k, t, gold[k, t]]
            total += np.log(np.exp(paths).sum()) - one
            assert gold_score < 0
        return total

    told, moved = language.likelihood_step(scores, move, gold)
    for at in ((0, 0, 1), (1, 3, 2), (0, 2, 0)):
        near = scores.copy()
        near[at] += 1e-6
        assert (loss(near, move) - loss(scores, move)) / 1e-6 == pytest.approx(told[at], abs=1e-4)


def test_code_switched_words(spark):
    field = small_field()
    text = "abcde bcdea cdeab deabc eabcd abcce vwxyz wxyzv xyzvw yzvwx zvwxy vwxyy"
    runs = sorted(language.label_words(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id bigint, text string"), field).collect(), key=lambda r: r.first_word)
    assert [(r.doc_id, r.first_word, r.n_words, r.lang) for r in runs] == [(1, 0, 6, "aa"), (1, 6, 6, "zz")]


def test_every_language_is_learned(spark, monkeypatch):
    """Seventy languages, the rarer ones too, each with a lexicon of its own; the pieces come from whole texts."""
    rng = random.Random(5)
    lexicons = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(30)] for _ in range(70)]
    given = [(n, f"l{n % 70:02d}", " ".join(rng.choices(lexicons[n % 70], k=60))) for n in range(70 * 8) if n % 70 < 60 or n < 140]
    frame = spark.createDataFrame(given, "doc_id bigint, lang string, text string")
    monkeypatch.setattr(language, "STEPS", 100)
    field = language.fit(frame, F.lit(True))
    assert len(field.languages) == 70
    got = {r.doc_id: r.lang_pred for r in language.predict(frame, field).collect()}
    assert sum(got[n] == lang for n, lang, _ in given) / len(given) > 0.95
    assert {got[n] for n, _, _ in given} == set(field.languages)
    many = spark.range(language.MOST_LANGUAGES + 1).selectExpr("id AS doc_id", "concat('l', id) AS lang", "'some text' AS text")
    with pytest.raises(ValueError, match="languages"):
        language.fit(many, F.lit(True))


def test_pieces_come_from_whole_texts(spark, monkeypatch):
    given = [(1, "en", "".join(f"w{n:05d} " for n in range(3000))), (2, "en", ""), (3, "fr", "un deux trois")]
    frame = spark.createDataFrame(given, "doc_id bigint, lang string, text string")
    every = language.pieces(frame, 10_000).collect()
    assert sorted(r.piece for r in every) == sorted([given[0][2][i : i + 512] for i in range(0, 21000, 512)] + [given[2][2]])
    assert [sum(r.head for r in every), sum(r.tail for r in every)] == [2, 2]
    few = language.pieces(frame, 10).collect()
    assert 3 <= len([r for r in few if r.lang == "en"]) <= 20 and {r.piece for r in few} <= {r.piece for r in every}
    monkeypatch.setattr(language, "STEPS", 3)
    tricky = language.fit(spark.createDataFrame([(1, "en", "x" * 3000)], "doc_id bigint, lang string, text string"), F.lit(True))
    assert tricky.languages == ["en"]


def test_language_odd_inputs(spark):
    got = language.predict(odd_documents(spark), small_field()).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {2, 3, 6, 8}
    assert {r.lang_pred for r in language.predict(odd_documents(spark), None).collect()} == {"und"}
    assert language.fit(no_documents(spark), F.lit(True)) is None
    assert language.fit(odd_documents(spark), fold(F.col("doc_id"), 5) != 0) is not None
