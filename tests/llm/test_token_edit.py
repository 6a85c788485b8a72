"""Edited counts against encoding the whole edited text anew."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keystar.llm import token_edit
from keystar.llm.queries import EDITS, QUERIES
from keystar.llm.token_edit import CountTree, TokenCounter, count_edited
from tests.conftest import rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
COUNTER = TokenCounter(PATH)
TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def plain(text: str) -> int:
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


ODD = [
    "", "   ", " a  b\n\n c\t", "it's we'll 'tis don''t", "12ab34 ½ Ⅷ ٣", "x\x85y\xa0z w\x1ca\x1fb",
    "日本語 テスト", "\U0001f600\U0001f468‍\U0001f469 ok", "<|endoftext|> x", "é ñ", "!!! ... --",
]


@pytest.mark.parametrize("text", ODD)
def test_whole_texts(text):
    assert CountTree(text, COUNTER).n_tokens == plain(text)


@pytest.mark.parametrize("leaf", [2, 64])
def test_random_edits(monkeypatch, leaf):
    monkeypatch.setattr(token_edit, "LEAF", leaf)
    rng = random.Random(leaf)
    pieces = [" ", "  ", "\n", "a", "word", " it's", "'", "7", "!", "é", "日", "\xa0", "\t ", "x y z"]
    for _ in range(60):
        tree = CountTree("".join(rng.choices(pieces, k=rng.randrange(120))), COUNTER)
        for _ in range(12):
            start = rng.randrange(-2, len(tree.text) + 3)
            end = start + rng.choice([0, 0, 1, 2, 30, 500])
            new = "".join(rng.choices(pieces, k=rng.choice([0, 1, 3, 40])))
            want = tree.text[: max(0, start)] + new + tree.text[max(0, start, end) :]
            tree.edit(start, end, new)
            assert tree.text == want
            assert tree.n_tokens == plain(want)
            assert tree.chars[1] == len(want)


def test_only_the_touched_region_is_read():
    tree = CountTree("some words in a row, " * 20_000, COUNTER)
    tree.edit(200_000, 200_004, "other")
    assert tree.reencoded < 60 and tree.n_tokens == plain(tree.text)


def test_odd_rows(spark):
    kind = "array<struct<start:int,end:int,new:string>>"
    data = [
        (1, None, [(0, 0, "new text")]),
        (2, "", None),
        (None, "a b c", [None, (None, 2, "x"), (1, 3, None), (99, 100, " end")]),
        (3, "x" * 100_000, [(50_000, 50_001, " ")]),
        (3, "same", []),
        (3, "same", []),
    ]
    frame = spark.createDataFrame(data, f"doc_id long, text string, edits {kind}")
    got = count_edited(frame, F.col("edits"), PATH)
    want = [
        (1, 0, 0, 1, plain("new text")),
        (2, 0, 0, 0, 0),
        (None, 5, 3, 2, plain("a c end")),
        (3, 100_000, plain("x" * 100_000), 1, plain("x" * 50_000 + " " + "x" * 49_999)),
        (3, 4, 1, 0, 1),
        (3, 4, 1, 0, 1),
    ]
    columns = ("doc_id", "n_chars", "n_tokens", "n_edits", "edited_tokens")
    assert rows(got, *columns) == sorted(want, key=repr)
    assert rows(count_edited(frame.limit(0), F.col("edits"), PATH)) == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op4_edited_token_counts"](spark, sf).collect()}
    docs = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    for doc in docs:
        text, n = doc["text"], len(doc["text"])
        row = got[doc["doc_id"]]
        assert (row.n_chars, row.n_tokens, row.n_edits) == (n, plain(text), len(EDITS))
        for share, cut, new in EDITS:
            at = n * share // 100
            text = text[:at] + new + text[at + cut :]
        assert (row.edited_chars, row.edited_tokens) == (len(text), plain(text))
