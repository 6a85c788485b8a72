"""Ids against the library on odd and whole texts; decoding round trips."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece

from keystar.llm import piece_index
from keystar.llm.piece_index import Pieces, decode_ids, encode, encode_batch, occurrences, suffix_array
from keystar.llm.queries import QUERIES
from tests.conftest import rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = Pieces(PATH)

ODD = [
    "", " ", "  two  spaces ", "Hello, World!", "tab\tline\nline\r\n", "日本語 テスト", "\U0001f600 x",
    "▁literal▁mark", "<s> </s> <unk> <0x41>", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "é ﬁ ½", "a" * 500 + " " + "ab" * 300, " " * 100, "x" * 63 + "y" * 3, "\x00\x01 \x7f",
    "internationalization of tokenization, 12345 67.89",
]


def test_odd_texts():
    got = encode_batch(Pieces(PATH), ODD)
    for text, ids in zip(ODD, got, strict=True):
        assert ids.tolist() == LIBRARY.encode(text), text
        assert decode_ids(PIECES, ids.tolist()) == text.replace("▁", " ")


def test_random_texts(monkeypatch):
    monkeypatch.setattr(piece_index, "INDEX_CHARS", 50)
    monkeypatch.setattr(piece_index, "SHORT", 6)
    rng = random.Random(4)
    parts = ["the", "ing", " ", "  ", "tion", "a", "b", "é", "日", "\n", "0", ",", "▁", "ss"]
    batch = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(120)]
    for text, ids in zip(batch, encode_batch(Pieces(PATH), batch), strict=True):
        assert ids.tolist() == LIBRARY.encode(text), text


@pytest.mark.parametrize("bits", [2, 13, 21, 31])
@pytest.mark.parametrize("seed", range(3))
def test_suffix_array_finds_every_occurrence(seed, bits):
    rng = random.Random(seed)
    text = "".join(rng.choices("abc", k=200))
    words = ["".join(rng.choices("abc", k=rng.randrange(1, 6))) for _ in range(40)] + ["zz"]
    codes = np.array([ord(c) - ord("a") + 1 for c in text])
    order = suffix_array(codes, 5, bits)
    assert [text[i : i + 5] for i in order] == sorted(text[i : i + 5] for i in range(200))
    table = np.zeros((len(words), 5), dtype=np.int64)
    for row, word in enumerate(words):
        table[row, : len(word)] = [ord(c) - ord("a") + 1 if c != "z" else -1 for c in word]
    low, high = occurrences(codes, order, table, np.array([len(w) for w in words]), bits)
    for word, a, b in zip(words, low, high, strict=True):
        want = [i for i in range(200) if text.startswith(word, i)]
        assert sorted(order[a:b].tolist()) == want


def test_odd_rows(spark):
    data = [(1, None, 5), (None, "a b", 5), (2, "twice", 5), (2, "twice", 5)]
    frame = spark.createDataFrame(data, "doc_id long, text string, ids int")
    got = encode(frame, PATH)
    want = [(i, LIBRARY.encode(t or "")) for i, t, _ in data]
    assert rows(got, "doc_id", "ids") == sorted(want, key=repr)
    assert rows(piece_index.decode(got, PATH), "doc_id", "text") == sorted(
        [(i, t or "") for i, t, _ in data], key=repr
    )
    assert rows(encode(frame.limit(0), PATH)) == []
    carried = piece_index.decode(encode(frame.withColumnRenamed("ids", "n"), PATH, carried=("n",)), PATH)
    assert carried.columns == ["doc_id", "ids", "ids_crc32", "n", "text"]
    assert {r.n for r in carried.collect()} == {5}
    lists = spark.createDataFrame([(1, None), (2, []), (3, [260, 261])], "k int, ids array<int>")
    found = dict(rows(piece_index.decode(lists, PATH), "k", "text"))
    assert found == {1: None, 2: "", 3: LIBRARY.decode([260, 261])}


def test_decoding_of_slices():
    ids = pa.array([LIBRARY.encode(x) for x in ODD] + [None], pa.list_(pa.int32()))
    want = [x.replace("▁", " ") for x in ODD] + [None]
    for start in range(len(ids)):
        part = ids.slice(start, 3)
        assert piece_index.decode_lists(PIECES, part) == want[start : start + 3]


def test_rows_without_an_id_round_trip(spark, tmp_path):
    data = [(None, "no id"), (1, "a\u2581b"), (1, "a\u2581b"), (2, None), (None, "no id"), (None, "日本 \n x")]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op6_sentencepiece"](spark, str(tmp_path)).collect()
    assert len(got) == len(data) and all(r.round_trip for r in got)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    want = []
    for doc in pq.read_table(f"{sf}/documents.parquet").to_pylist():
        ids = np.array(LIBRARY.encode(doc["text"]), dtype="<u4")
        want.append((doc["doc_id"], len(ids), zlib.crc32(ids.tobytes()), True))
    got = QUERIES["op6_sentencepiece"](spark, sf)
    assert rows(got, "doc_id", "n_ids", "ids_crc32", "round_trip") == sorted(want, key=repr)
