"""Windows of benchmark items in documents, against plain search, on odd inputs, and in several blocks."""

import random
import re

import pytest

from eventlake.llm import decontaminate
from tests.llm.frames import no_documents, odd_documents, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(document, items):
    words = WORD.findall((document or "").translate(LOWER))
    hit, found = set(), set()
    for name, text in items:
        own = WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(own) - 9)) if own else []:
            window = own[i : i + 10]
            for j in range(len(words) - len(window) + 1):
                if words[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
                    found.add(name)
    return len(words), len(hit), sorted(found)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id string, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_hits_equal_plain_search(spark, block_bytes):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "D", "é", "straße", "42"]
    items = [(str(i), " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 10, 11, 14])))) for i in range(12)]
    items += [("none", None), ("blank", " ... "), ("3", items[5][1])]
    docs = []
    for _ in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 40))
        if rng.random() < 0.6:
            words[5:5] = (items[rng.randrange(12)][1]).upper().split()
        docs.append(rng.choice([" ", ", ", "\n--"]).join(words))
    got = {r.doc_id: r for r in decontaminate.contamination(texts(spark, *docs), items_frame(spark, items), block_bytes=block_bytes).collect()}
    for i, document in enumerate(docs):
        # "É" is not lower-cased: only A to Z are.
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == plain(document, items)


def test_hits_point_into_the_original(spark):
    item = "one two three four five six seven eight nine ten eleven"
    document = "Zürich! " + item.upper().replace(" ", " - ") + " end"
    row = decontaminate.contamination(texts(spark, document), items_frame(spark, [("q", item)])).first()
    (hit,) = row.hits
    assert document[hit.start : hit.stop] == item.upper().replace(" ", " - ")
    assert (hit.first_word, hit.last_word) == (1, 11)


def test_odd_inputs(spark):
    items = items_frame(spark, [("q", "hello WORLD this is a text")])
    found = decontaminate.contamination(odd_documents(spark), items).collect()
    assert len(found) == 10
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_hit) for r in found if r.n_hit) == [(False, 1, 6), (False, 1, 6)]
    assert {r.n_words for r in found if r.doc_id in (2, 3)} == {0}
    assert decontaminate.contamination(no_documents(spark), items).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(odd_documents(spark), items.limit(0)).collect()} == {0}


def test_clean_documents_keep_their_columns(spark):
    items = items_frame(spark, [("q", "hello world this is a text")])
    odd = odd_documents(spark)
    kept = decontaminate.clean_documents(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == 8 and kept.where("doc_id = 1").count() == 0
