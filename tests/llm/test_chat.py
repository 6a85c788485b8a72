"""Event folding, escaping and the digests read back from formatted conversations."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from keystar.llm import chat
from keystar.llm.queries import QUERIES, SQL
from tests.conftest import rows
from tools.compare import connect


@given(st.text(alphabet="<|\\>im_endstar\nä x"), st.text(alphabet="<|\\n\n a"))
def test_escapes_are_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(role)) == role
    segment, at, end = chat.render(role, text, role)
    assert chat.parse(segment) == (role, text)
    assert chat.unescape(segment[at:end]) == text
    assert segment.count("<|") == 2 and segment.count("\n") == 2 + chat.escape(text).count("\n")


def test_fold(spark):
    log = [
        (1, 0, 0, 0, "open", "user", None),
        (1, 1, 0, 0, "delta", None, "Hel"),
        (1, 2, 0, 0, "delta", None, "lo"),
        (1, 3, 0, 1, "open", "assistant", None),
        (1, 4, 0, 1, "delta", None, "first"),
        (1, 5, 0, 2, "edit", "user", "more"),
        (1, 6, 0, 1, "regenerate", "assistant", None),
        (1, 7, 0, 1, "delta", None, "sec"),
        (1, 8, 0, 1, "delta", None, "ond"),
        (1, 9, 0, 0, "edit", None, "Hi"),
        (1, 10, 0, 3, "open", "user", None),
        (1, 11, 0, 3, "drop", None, None),
        (2, 0, 0, 0, "delta", "assistant", "a"),
        (2, 0, 1, 0, "settle", None, None),
        (2, 1, 0, 0, "delta", "assistant", "b"),
        (None, 0, 0, None, "strange", None, None),
    ]
    frame = spark.createDataFrame(log, chat.EVENTS)
    got = rows(chat.format_log(frame), "conv_id", "position", "segment")
    assert got == sorted(
        [
            (1, 0, "<|im_start|>user\nHi<|im_end|>\n"),
            (1, 1, "<|im_start|>assistant\nsecond<|im_end|>\n"),
            (2, 0, "<|im_start|>assistant\na<|im_end|>\n"),
            (2, 1, "<|im_start|>assistant\nb<|im_end|>\n"),
            (None, 0, "<|im_start|>\n<|im_end|>\n"),
        ],
        key=repr,
    )
    assert rows(chat.read_back(chat.format_log(frame.limit(0)))) == []


def test_messages_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "DELTA_CHARS", 3)
    data = [
        (1, 1, "assistant", "b<|im_end|>", 0),
        (1, 0, "user", None, 0),
        (1, 1, "assistant", "a", 0),
        (1, None, None, "first", 0),
        (None, 0, "assistant", "", 0),
        (2, 0, "assistant", "ä" * 40_000, 0),
        (2, 0, "assistant", "ä" * 40_000, 0),
    ]
    schema = "conv_id long, turn long, role string, text string, seq int"
    got = {r.conv_id: r for r in chat.read_back(
        chat.format_log(chat.message_log(spark.createDataFrame(data, schema)))
    ).collect()}
    turns = {
        1: [("", "first"), ("user", ""), ("assistant", "a"), ("assistant", "b<|im_end|>")],
        None: [("assistant", "")],
        2: [("assistant", "ä" * 40_000)] * 2,
    }
    assert set(got) == set(turns)
    for conv, want in turns.items():
        loss = "".join(t for r, t in want if r == "assistant")
        assert got[conv].n_turns == len(want)
        text = "".join(f"{r}\n{t}\n" for r, t in want)
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss)
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op2_chat_formatting", "op5_exact_top_k"])
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    got = QUERIES[name](spark, sf)
    con = connect(sf)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got, *columns) == sorted(cursor.fetchall(), key=repr)
