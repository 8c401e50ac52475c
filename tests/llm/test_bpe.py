"""Ids against the tiktoken library, and exact round trips."""

import random
import subprocess
import sys
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import bpe
from tests.llm.frames import SMALL, no_documents, odd_documents


def both(texts):
    ids, bounds = bpe.tokens_of().encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])], bpe.tokens_of().decode(ids, bounds)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_ids_and_round_trip(texts):
    ids, back = both(texts)
    assert ids == [bpe.encoding().encode_ordinary(t) for t in texts]
    assert back == [t.encode() for t in texts]


def test_long_words():
    rng = random.Random(3)
    texts = ["a" * 3001, "ab" * 2000, "=" * 1777, "é" * 555, "".join(rng.choices("etaoinshr", k=4000)), "".join(rng.choices("0123456789", k=1500)), "\n" * 999]
    texts += ["".join(rng.choices(letters, k=rng.randrange(60, 900))) for letters in ("ab", "aeiou", "tion", "AaBb", "xyz", "日本語", "-=") for _ in range(12)]
    ids, back = both(texts)
    assert ids == [bpe.encoding().encode_ordinary(t) for t in texts]
    assert back == [t.encode() for t in texts]


@pytest.mark.parametrize("seam", [1, 2])
def test_seams_are_mended_from_few_tokens_on(monkeypatch, seam):
    monkeypatch.setattr(bpe, "SEAM", seam)
    monkeypatch.setattr(bpe, "PIECE", 7)
    bpe.tokens_of().clear()
    rng = random.Random(seam)
    texts = ["".join(rng.choices(letters, k=rng.randrange(8, 400))) for letters in ("ab", "aeiou", "etaoinshrdlu", "zZ", "the") for _ in range(25)]
    texts += ["unbelievablyinternationalizationofrepresentationalstate" * 5, "a" * 333]
    assert both(texts)[0] == [bpe.encoding().encode_ordinary(t) for t in texts]
    bpe.tokens_of().clear()


@pytest.mark.parametrize("kind", ["letters", "base64", "one letter"])
def test_words_of_a_megabyte_end_within_a_minute(kind):
    rng = random.Random(7)
    if kind == "one letter":
        text = "a" * 5_000_000
    else:
        alphabet = "abcdefghijklmnopqrstuvwxyz" if kind == "letters" else "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
        text = "".join(rng.choices(alphabet, k=1_000_000))
    start = time.monotonic()
    ids, bounds = bpe.tokens_of().encode([text])
    assert time.monotonic() - start < 60
    assert ids.tolist() == bpe.encoding().encode_ordinary(text)
    bpe.tokens_of().clear()


def test_stored_words_start_anew(monkeypatch):
    monkeypatch.setattr(bpe, "STORED_WORDS", 3)
    for text in ("one two three four", "five six seven", "one two eight"):
        assert both([text])[0] == [bpe.encoding().encode_ordinary(text)]


def test_documents(spark):
    for documents in (odd_documents(spark), spark.read.parquet(f"{SMALL}/documents.parquet")):
        given_rows = sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in documents.select("doc_id", "text").collect())
        got = sorted(((r.doc_id is None, r.doc_id or 0), bytes(r.decoded).decode(), r.n_tokens, bpe.unpack(bytes(r["ids"]))) for r in bpe.encode_decode(documents).collect())
        assert [g[:2] for g in got] == given_rows
        assert all(g[3] == bpe.encoding().encode_ordinary(g[1]) and g[2] == len(g[3]) for g in got)
    assert bpe.encode_decode(no_documents(spark)).count() == 0


def test_packed_ids():
    assert bpe.unpack(np.array([1, 70000], "<u4").tobytes()) == [1, 70000]


# One task's work in a process of its own: MB that the work took beyond the vocabulary at most, and that stay after it.
WORKER = """
import random, re, types
import pyarrow as pa
from eventlake.llm import bpe

def held():
    return sum(map(int, re.findall(r"(?:RssAnon|RssShmem):\\s+(\\d+)", open("/proc/self/status").read()))) // 1024

bpe.texts_of = lambda documents: types.SimpleNamespace(mapInArrow=lambda run, schema: run)
run = bpe.encode_decode(None)
rng = random.Random(5)
words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(3, 12))) for _ in range(150_000)]
texts = [" ".join(rng.choices(words, k=300)) for _ in range(4_000)]
batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
bpe.tokens_of()
before, most, at = held(), 0, 0
for part in run(iter([batch])):
    most = max(most, held())
    for text in part.column(3).to_pylist():
        assert text.decode() == texts[at]
        at += 1
assert at == len(texts)
del part
print(most - before, held() - before)
"""


def test_a_task_leaves_little_memory_in_its_worker():
    most, left = map(int, subprocess.run([sys.executable, "-c", WORKER], capture_output=True, text=True, check=True).stdout.split())
    assert most < 180 and left < 90
