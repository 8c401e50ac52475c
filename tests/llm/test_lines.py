"""Line deduplication against a plain version; bitmaps, odd rows, spread of a busy line."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from eventlake.llm import lines, queries
from tests.llm.frames import SMALL, no_documents, odd_documents

WHITE = " \t\n\x0b\x0c\r"
CASE = str.maketrans(lines.UPPER, lines.LOWER)


def plain(rows, least_chars, least_docs):
    """Per row (id, lines, dropped, text); ids may be null or repeated."""
    split = [(doc_id, (text or "").split("\n")) for doc_id, text in rows]
    rank = lambda doc_id: (doc_id is not None, doc_id or 0)
    holders = {}
    for doc_id, found in split:
        for line in found:
            key = line.strip(WHITE).translate(CASE)
            if len(key) >= least_chars:
                holders.setdefault(key, set()).add(doc_id)
    keeper = {key: max(ids, key=rank) for key, ids in holders.items() if len(ids) >= least_docs}
    out = []
    for doc_id, found in split:
        kept = [x for x in found if keeper.get(x.strip(WHITE).translate(CASE), doc_id) == doc_id]
        out.append((doc_id, len(found), len(found) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(frame, **how):
    return sorted((tuple(r) for r in lines.apply_bitmaps(frame, lines.keep_bitmaps(frame, **how)).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    draw = random.Random(seed)
    stock = ["aa", "AA ", "\taa", "é", "É", "bbb", "", " ", "cc\x0b", "CC", "dd\x1f", "\U0001f600x"]
    rows = [(draw.choice([None, *range(-5, 20), 10**12, 10**12 + 1, 5000]), draw.choice([None, "", "\n".join(draw.choices(stock, k=draw.randrange(1, 150)))])) for _ in range(60)]
    frame = spark.createDataFrame(rows + rows[:10], "doc_id bigint, text string")
    assert run(frame, least_chars=2, least_docs=3) == plain(rows + rows[:10], 2, 3)


def test_odd_rows_and_no_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    assert run(odd_documents(spark), least_chars=3, least_docs=2) == plain(rows, 3, 2)
    assert run(no_documents(spark)) == []


def test_a_text_of_many_lines(spark):
    long = "\n".join(f"line number {i % 70_000}" for i in range(100_000))
    rows = [(1, long), (2, "x\n" + long), (3, "line number 5")]
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string"), least_chars=5, least_docs=2) == plain(rows, 5, 2)


def test_bitmaps_hold_only_words_that_lose_lines(spark):
    text = "\n".join([*(f"only here {i}" for i in range(200)), "the line they share"])
    frame = spark.createDataFrame([(1, text), (2, "the line they share")], "doc_id bigint, text string")
    (row,) = lines.keep_bitmaps(frame, least_chars=5, least_docs=2).collect()
    assert row.doc_id == 1 and [(w.word, w.bits) for w in row.keep] == [(3, ~(1 << 8))]
    assert not any(f.dataType.simpleString() == "string" for f in lines.keep_bitmaps(frame).schema)


def test_a_busy_line_is_spread(spark):
    frame = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("doc_id"), F.lit("a line that stands in every one of the documents here").alias("text"))
    rows = lines.long_lines(lines.texts_of(frame), 40)
    sizes = [n for n in rows.repartitionByRange(16, *lines.LINE, "block").rdd.glom().map(len).collect() if n]
    assert max(sizes) <= 2 * lines.BLOCK_IDS
    assert lines.keep_bitmaps(frame).count() == 59_999


def test_no_python_in_the_plan(spark):
    plan = queries.op11_line_dedup(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "InArrow", "InPandas", "ArrowEval", "MapPartitions", "Scan ExistingRDD"))


def test_digest_of_one_document(spark):
    row = queries.op11_line_dedup(spark, SMALL).where("n_dropped = 0").first()
    text = spark.read.parquet(f"{SMALL}/documents.parquet").where(F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
