"""Formatting and reading back, escaping, masks and odd inputs."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import bpe, chat

pieces = st.lists(st.sampled_from(["<|", "\\", "im_end", "im_start", "im_sep", "|>", "a", "é", "\n", "<|im_end|>", "<|\\im_sep|>"]), max_size=9).map("".join)
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_escaping_is_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(control in escaped for control in chat.CONTROL.values())


@settings(max_examples=100, deadline=None)
@given(st.sampled_from(["user", "assistant", "", "<|im_sep|>"]), pieces)
def test_a_turn_reads_back(role, text):
    encoding = bpe.encoding()
    ids, mask = chat.assemble(role, text, encoding.encode_ordinary)
    assert len(ids) == len(mask) and set(ids.tolist()) & set(chat.CONTROL) == set(chat.CONTROL)
    got_role, got_text, _ = chat.segments(ids.tolist(), encoding.decode)
    assert (chat.unescape(got_role), chat.unescape(got_text)) == (role, text)
    learned = chat.unescape(encoding.decode([i for i, m in zip(ids.tolist(), mask) if m]))
    assert learned == (text if role == "assistant" else "")


def test_conversations_read_back(spark):
    turns = [(1, 1, "assistant", "second"), (1, 0, "user", "first"), (1, 2, "assistant", None), (2, 0, None, "x"), (None, 0, "assistant", "<|im_end|>"), (3, None, "user", "t")]
    frame = spark.createDataFrame(turns, SCHEMA).selectExpr("*", "text AS ids", "role AS mask")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(frame)).collect()}
    assert set(got) == {1, 2, 3, None}
    assert got[1].n_turns == 3
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nfirst\nassistant\nsecond\nassistant\n\n").hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(b"second").hexdigest() and got[1].loss_chars == 6
    assert got[None].loss_sha256 == hashlib.sha256(b"<|im_end|>").hexdigest()
    assert got[2].formatted_chars == 1 + sum(map(len, chat.CONTROL.values()))


def test_no_conversations(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0
