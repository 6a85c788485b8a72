"""Kneser-Ney ratios against a plain model, odd rows, and held-out accuracy."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from keystar import session
from keystar.llm import toxicity
from keystar.llm.queries import QUERIES
from keystar.llm.toxicity import ORDER, SHARED, fit_curve, packed_grams, score_documents, words_of
from tests.conftest import rows

BAD = ["vequai", "lowein", "idiot", "chllado"]


def corpus(n, seed):
    rng = random.Random(seed)
    syllables = ["an", "er", "the", "on", "ti", "re", "le", "qu"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(40)]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.8:
            labels.append((i, 1, toxic))
    return docs, labels


def plain_ratio(docs, labels, word):
    """The ratio of the final models by dictionaries of strings."""
    toxic = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    top = {"all": Counter(), 1: Counter(), 0: Counter()}
    for i, text in docs:
        for w in text.split():
            padded = "^" * (ORDER - 1) + w + "$"
            grams = [padded[j : j + ORDER] for j in range(len(w) + 1)]
            top["all"].update(grams)
            if i in toxic:
                top[toxic[i]].update(grams)
    levels = {}
    for name, counts in top.items():
        levels[name, ORDER] = counts
        for k in range(ORDER - 1, 0, -1):
            levels[name, k] = Counter(g[1:] for g in levels[name, k + 1])

    def chance(name, gram):
        k = len(gram)
        if k == 0:
            return 1 / 1024
        lower = chance("all" if k - 1 <= SHARED else name, gram[1:])
        counts = levels[name, k]
        after = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
        if not after:
            return lower
        return (max(counts[gram] - 0.75, 0) + 0.75 * len(after) * lower) / sum(after)

    padded = "^" * (ORDER - 1) + word + "$"
    grams = [padded[j : j + ORDER] for j in range(len(word) + 1)]
    return sum(math.log(chance(1, g)) - math.log(chance(0, g)) for g in grams)


def test_ratios_are_kneser_ney(spark, monkeypatch):
    docs, labels = corpus(90, 1)
    caught = {}
    real = toxicity.packed_tables
    monkeypatch.setattr(toxicity, "packed_tables", lambda t: caught.update(t) or real(t))
    score_documents(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    ).count()
    for word in ("idiot", "an", "vequre", "quququ", "zzz", "lowe"):
        got = toxicity.word_log_ratios([word, "the"], caught, "t", "o")[0]
        assert got == pytest.approx(plain_ratio(docs, labels, word), abs=1e-3)


def test_odd_rows(spark):
    docs, labels = corpus(150, 2)
    docs += [
        (1000, None), (1001, ""), (1002, " \n"), (1003, "idiot " * 30_000), (1004, "x" * 5000),
        (1005, "!!! ... \U0001f600 日本語 \x01\x02"), (7, docs[7][1]), (None, "lowein idiot vequai"),
    ]
    labels += [(5000, 1, 1), (7, 1, None), (8, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame(
        [(i, t, "s", 0.5) for i, t in docs], "doc_id long, text string, toxic string, score double"
    )
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = score_documents(frame, marks).collect()
    assert len(got) == len(docs)
    for r in got:
        known = r.doc_id is not None
        assert r.held_out == (known and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1003].predicted == by_id[None].predicted == 1
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score < 0.7
    assert rows(score_documents(frame.limit(0), marks)) == []
    unlabelled = score_documents(frame, marks.limit(0)).collect()
    assert {round(r.score, 6) for r in unlabelled} == {0.01}


def test_filter_keeps_rows_whole(spark):
    docs, labels = corpus(150, 2)
    docs += [(1000, None), (1001, ""), (None, "lowein idiot vequai"), (7, docs[7][1])]
    data = [(i, t, f"d{n}", n) for n, (i, t) in enumerate(docs)]
    frame = spark.createDataFrame(data, "doc_id long, text string, _digest string, score int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = score_documents(frame, marks).where("predicted = 1").collect()
    gone = {(r.doc_id) for r in scored}
    got = toxicity.without_toxic(frame, marks)
    assert got.columns == frame.columns
    assert rows(got) == sorted([x for x in data if x[0] not in gone], key=repr)
    assert None in gone and 1000 not in gone
    assert rows(toxicity.without_toxic(frame.limit(0), marks)) == []


def test_held_out_labels_are_not_read(spark):
    docs, labels = corpus(120, 3)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    one, two = (
        rows(score_documents(frame, spark.createDataFrame(x, "doc_id long, q int, toxic int")))
        for x in (labels, flipped)
    )
    assert one == two


def test_grams_and_words():
    gram, owner = packed_grams(["ab", "", "日"])
    assert owner.tolist() == [0, 0, 0, 1, 2, 2]
    assert (gram[:2] & 1023).tolist() == [ord("a"), ord("b")]
    assert words_of("...") == ["..."] and words_of('"it\'s",') == ["it's"]
    assert "".join(words_of("y" * 1000)) == "y" * 1000


def test_flat_curve():
    weights, offset = fit_curve(np.ones((5, 2)), np.zeros(5))
    assert weights.tolist() == [0, 0] and offset == pytest.approx(math.log(0.01 / 0.99))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_toxicity"](spark, sf)
    seen = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    table = defaultdict(int)
    for r in seen.collect():
        table[r.toxic, r.predicted] += 1
    assert table[0, 1] <= 0.02 * (table[0, 0] + table[0, 1])
    assert table[1, 1] >= 0.7 * (table[1, 0] + table[1, 1])


def test_ngrams_share_no_counts(spark, monkeypatch):
    # Six letters that were in one slot of 499,979, and characters that were folded into one.
    codes = np.random.default_rng(5).integers(97, 123, (4000, ORDER))
    slot = (codes << (10 * np.arange(ORDER)[::-1])).sum(axis=1) % 499_979
    first, last = next(
        (np.flatnonzero(slot == s)[:2] for s in slot if (slot == s).sum() > 1)
    )
    bad, good = ("".join(map(chr, codes[i])) for i in (first, last))
    wide, other = "\u65e5" * 6, chr(0x65E5 + 512) * 6
    assert bad != good
    docs = [(i, f"{bad} {wide}" if i % 2 else f"{good} {good} {other}") for i in range(40)]
    labels = [(i, 1, i % 2) for i in range(40)]
    caught = {}
    real = toxicity.packed_tables
    monkeypatch.setattr(toxicity, "packed_tables", lambda t: caught.update(t) or real(t))
    score_documents(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    ).count()
    words = [bad, good, wide, other]
    got = toxicity.word_log_ratios(words, caught, "t", "o")
    want = [plain_ratio(docs, labels, w) for w in words]
    assert got == pytest.approx(want, abs=1e-3)
    assert got[0] > 1 > -1 > got[1] and got[2] > 1 > -1 > got[3]


def test_texts_are_read_once_and_scratch_goes(spark, tmp_path, monkeypatch):
    """Texts go through one Python pass, and only the model's tables and features stay."""
    docs, labels = corpus(60, 4)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    read = frame.mapInArrow(counted, frame.schema)
    assert score_documents(read, marks).count() == len(docs)
    assert seen.value == len(docs)
    kept = {x.name.split("-")[0] for x in tmp_path.iterdir()}
    assert kept == {"grams", "histories", "evidence"}


def test_bags():
    numbers = np.array([5, 0, 70_000, 5], dtype=np.int32)
    times = np.array([1, 300, 2, 7], dtype=np.int32)
    got = toxicity.unpacked_bag(toxicity.packed_bag(numbers, times))
    assert sorted(zip(*(x.tolist() for x in got), strict=True)) == [(0, 300), (5, 1), (5, 7), (70_000, 2)]
    none = np.zeros(0, dtype=np.int32)
    assert [len(x) for x in toxicity.unpacked_bag(toxicity.packed_bag(none, none))] == [0, 0]
