"""Cuts by the block tree against plain cuts, forms, and the round trip."""

import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import middle
from tests.llm.frames import no_documents, odd_documents, texts

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
pieces = st.text(alphabet=st.sampled_from(list(" \n\t\x0b\x1f　aBé\U0001f600<")), max_size=60)


def plain(doc_id, text, seed=42, rate=50, spm_rate=80):
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return len(units), "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


@settings(max_examples=300, deadline=None)
@given(pieces, pieces, st.sampled_from([1, 2, 3, 8, 512]))
def test_every_cut(before, text, block):
    flat, offsets = middle.text_bytes(pa.array([before, text, " x "]))
    ends, points = middle.marks(flat, offsets)
    tree = middle.BlockTree(ends[offsets[1] : offsets[2]], points[offsets[1] : offsets[2]], block)
    units = UNIT.findall(text)
    assert tree.total() == (len(units), len(text))
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert tree.cut(k) == (len(head.encode()), len(head))


@pytest.mark.parametrize("rate, spm_rate, block", [(50, 80, 512), (100, 0, 7), (100, 100, 64)])
def test_rows_equal_the_plain_version_and_restore(spark, rate, spm_rate, block):
    given = [r.text for r in odd_documents(spark).collect()] + ["a <P> b", "a <S", "<", "<P", "S>M>", "x  ", "\n", "é" * 5000 + " z"] * 3
    frame = texts(spark, *given)
    formed = middle.transform(frame, rate=rate, spm_rate=spm_rate, block=block)
    got = {r.doc_id: r for r in formed.select("*", middle.restored(formed.output, formed.form).alias("back")).collect()}
    for i, text in enumerate(given):
        row = got[i]
        assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == plain(i, text or "", rate=rate, spm_rate=spm_rate)
        assert row.back == (text or "")


def test_odd_rows_and_no_rows(spark):
    rows = middle.transform(odd_documents(spark)).collect()
    assert len(rows) == odd_documents(spark).count()
    for row in rows:
        if row.doc_id is None:
            assert row.form == plain(None, "a row without an id")[1]
    assert len({tuple(r) for r in rows if r.doc_id == 1}) == 1
    assert middle.transform(no_documents(spark)).count() == 0


def test_a_very_long_text(spark):
    text = "word and wörd\n" * 400_000
    row = middle.transform(texts(spark, text), rate=100).first()
    assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == plain(0, text, rate=100)
