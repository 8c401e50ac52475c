"""Each stage of the corpus pipeline on its own input, against plain versions."""

import pytest

import corpus_pipeline
from eventlake.llm import bpe
from tests.llm.frames import SMALL
from tests.llm.test_decontaminate import plain
from tests.llm.test_duplicates import plain_join
from tests.llm.test_pii import plain_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage returned, written and read again."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "personal data", "byte-level BPE"]


def test_all_but_the_last_return_documents(steps):
    assert all(df.columns == COLUMNS for df in steps[:-1])


def test_quality_keeps_clean_documents(spark, steps):
    before, after = by_id(steps[0]), by_id(steps[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) > 0.95 * len(good) and sum(i in after for i in bad) < 0.4 * len(bad)
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_group_stays(steps):
    before, after = by_id(steps[1]), by_id(steps[2])
    want = {i for i, _, component in plain_join([(i, r.text) for i, r in before.items()], 5, 80) if i == component}
    assert set(after) == want and all(after[i] == before[i] for i in after)


def test_contaminated_documents_go(spark, steps):
    before, after = by_id(steps[2]), by_id(steps[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {i for i, r in before.items() if not plain(r.text, items)[1]}
    assert set(after) == clean and len(clean) < len(before)


def test_personal_data_is_masked(steps):
    before, after = by_id(steps[3]), by_id(steps[4])
    assert set(before) == set(after)
    marked = 0
    for i, row in before.items():
        spans = plain_spans(row.text)
        marked += bool(spans)
        if spans:
            assert "[" in after[i].text and after[i].n_chars == len(after[i].text)
            assert not any(row.text[a:b] in after[i].text for _, a, b in spans)
        else:
            assert after[i] == row
    assert marked


def test_tokens_round_trip(steps):
    before, after = by_id(steps[4]), by_id(steps[5])
    assert set(before) == set(after)
    for i, row in before.items():
        assert after[i].text == row.text and bpe.unpack(bytes(after[i]["ids"])) == bpe.encoding().encode_ordinary(row.text)


WIDE = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_hit string, component_id string, _gone int, _bad int"


def wide(spark, *rows):
    return spark.createDataFrame([(i, text, "en", "s", 1, "x", "y", 7, 8) for i, text in rows], WIDE)


def test_duplicates_of_rows_without_or_with_repeated_ids(spark):
    first, second = "one two three four five six seven eight nine ten", "completely other words stand in this longer text of mine"
    docs = wide(spark, (None, first), (3, first), (4, first), (None, second), (9, "all alone here now and then"), (9, "all alone here now and then"), (None, None), (11, ""), (None, "x y"))
    left = corpus_pipeline.duplicates_stage(spark, docs, SMALL)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(None, first), (None, second), (9, "all alone here now and then"), (9, "all alone here now and then"), (None, None), (11, ""), (None, "x y")], key=repr
    )


def test_contamination_of_rows_without_or_with_repeated_ids(spark):
    item = next(r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if len(r.text.split()) > 12)
    docs = wide(spark, (None, "clean words"), (None, item), (5, item), (5, "clean as well"), (6, None), (6, ""))
    left = corpus_pipeline.benchmark_stage(spark, docs, SMALL)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([(None, "clean words"), (5, "clean as well"), (6, None), (6, "")], key=repr)


def test_stages_on_an_empty_table(spark):
    docs = wide(spark, (1, "x")).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0, name


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()) == sorted(r.doc_id for r in steps[-1].collect())
