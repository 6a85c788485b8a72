"""Tokens by the plain tokenizer; packings that are whole, gapless and near the bound."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from keystar.llm import word_bpe
from keystar.llm.packing import Packer, pack
from keystar.llm.queries import QUERIES
from keystar.llm.word_bpe import ChunkEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def plain_ids(text: str | None) -> list[int]:
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


ODD = [
    "", " \n\t ", "Hello, World!", "it's we'll I'd 'tis rock'n'roll", "a.b,c;d--e", "ÀÉß ÿ Œ œ",
    "é ́x a b c d\x85e", "x\x1cy\x1dz\x0bq\x0cw", "ΑΣ ΣΑΣ İi ǅ", "日本語 テスト 12３",
    "<|endoftext|> <|startoftext|>x", "don't!!! ***bold*** $$$ 1,234.5", "​zero ﻿bom \U0001f600\U0001f468‍\U0001f469",
    "under_score _x_ ÷ × a÷b", "ﬁ ﬂ Ⅷ ² ª", "\x00 \x01a", "W" * 300, "éÉ.,", "(a) [b] {c} `d` ~e",
]


@pytest.mark.parametrize("text", ODD)
def test_chunks_give_the_tokenizers_ids(text):
    got = ChunkEncoder(PATH).encode([text, text])
    assert np.frombuffer(got[0], "<u4").tolist() == plain_ids(text)
    assert got[0] == got[1]


def test_store_is_emptied(monkeypatch):
    monkeypatch.setattr("keystar.llm.word_bpe.REMEMBERED", 3)
    encoder = ChunkEncoder(PATH)
    for text in ("one two three, four", "five six seven.", "one two eight, nine"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain_ids(text)


def is_packing(bins, n):
    return sorted(x for b in bins for x in b) == list(range(n))


def test_genetic_steps_keep_every_item():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 100) for _ in range(500)]
    packer = Packer(lengths, 100, seed=2)
    mother, father = packer.first(), packer.shuffled()
    for bins in (
        mother, father, packer.cross(mother, father), packer.mutate(mother),
        packer.evolve([mother, father]), packer.evolve([[[x] for x in range(500)]]),
    ):
        assert is_packing(bins, 500)
        assert max(map(packer.fill, bins)) <= 100
    best = packer.evolve([mother, father])
    assert len(best) <= min(len(mother), len(father))
    assert len(best) <= -(-sum(lengths) // 100) + 5


def verify(docs, got, length):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    want = defaultdict(list)
    for i, text in docs:
        ids = np.array([*plain_ids(text), 0], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            want[i].append((piece, at, len(part), zlib.crc32(part.tobytes())))
    for i in want:
        found = [(r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]]
        assert sorted(found) == sorted(want[i])
    assert set(by_doc) == set(want)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    total = sum(r.length for r in got)
    return len(by_sequence), -(-total // length)


def test_odd_rows(spark):
    docs = [(i, t) for i, t in enumerate(ODD)] + [
        (90, None), (None, "no id"), (91, "twice"), (91, "twice"), (92, "word " * 60),
    ]
    frame = spark.createDataFrame(
        [(i, t, 1, 2) for i, t in docs], "doc_id long, text string, length int, row int"
    )
    used, bound = verify(docs, pack(frame, PATH, length=32).collect(), 32)
    assert used <= bound + 2
    assert pack(frame.limit(0), PATH).collect() == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{sf}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    got = QUERIES["op8_best_fit_packing"](spark, sf).collect()
    used, bound = verify([(d["doc_id"], d["text"]) for d in docs], got, 2048)
    assert used <= bound + 2


def test_contractions_and_a_larger_store_for_tokens(monkeypatch):
    """The pattern's order of branches changes no token; short pre-tokens are remembered longer."""
    monkeypatch.setattr("keystar.llm.word_bpe.REMEMBERED", 4)
    encoder = ChunkEncoder(PATH)
    for text in ("'s 'S 'lll ''s 'tt x'y we'll've'd'm 're're '' '1 1's", "a b c d e", "f"):
        got = encoder.encode([text])[0]
        assert np.frombuffer(got, "<u4").tolist() == plain_ids(text)
    fresh = ChunkEncoder(PATH)
    fresh.encode(["a b c d e"])
    fresh.encode(["f"])
    assert len(fresh.tokens.young) == 6 and not fresh.tokens.old


def test_each_distinct_token_of_a_batch_is_looked_up_once(monkeypatch):
    """Cut by classes of characters as by the tokenizer; repeats cost no look-up of their own."""
    asked = []
    prepare = word_bpe.Remembered.prepare

    def counted(self, rows):
        asked.extend(key for keys in rows for key in keys)
        prepare(self, rows)

    monkeypatch.setattr(word_bpe.Remembered, "prepare", counted)
    encoder = ChunkEncoder(PATH)
    encoder.encode(["the cat, the dog"] * 50 + ["", "The 11 cats"])
    assert len(asked) == len(set(asked)) == 6
    rng = random.Random(8)
    parts = ["'", "''", "s", "re", "ve", "ll", "T", "M", "d", "l", "É", "ß", "1", "-", " ", "\n", "7'"]
    batch = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(3000)]
    for text, got in zip(batch, encoder.encode(batch), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == plain_ids(text), text
