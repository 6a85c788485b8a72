"""The n-gram join against comparing all pairs."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keystar.llm import ngram_join, ngrams
from keystar.llm.ngram_join import global_order, ngram_components
from keystar.llm.queries import QUERIES
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


def plain_set(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)) if words)


def plain(docs):
    sets = [plain_set(t) for _, t in docs]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for gram in s:
            holders[gram].add(i)
    label = list(range(len(docs)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    near = {p for h in holders.values() for p in combinations(sorted(h), 2)}
    for i, j in near:
        common = len(sets[i] & sets[j])
        if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
            label[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(
        ((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))),
        key=repr,
    )


def check(spark, docs):
    frame = spark.createDataFrame(
        [(i, t, 7, "n", 3) for i, t in docs],
        "doc_id long, text string, n int, gram string, cls int",
    )
    got = rows(ngram_components(frame), "doc_id", "n_shingles", "component_id")
    assert got == plain(docs)


@pytest.mark.parametrize("window", [1 << 20, 5])
def test_sets(monkeypatch, window):
    monkeypatch.setattr(ngrams, "WINDOW", window)
    texts = [
        None, "", " \t\n\x0b\x0c\r", "One", "one", "a b", "b a", "a b c", "A b c d", "a b c d e",
        "É x y z é x y z", "ab ab ab ab ab ab", "x\x0by\x0cz  w\r\nq", "aa a", "a aa", "wwwwwwwwwwwwwww q",
    ]
    row, gram = ngrams.ngram_sets(pa.array(texts, pa.string()), 4)
    found = [set(gram[row == i].tolist()) for i in range(len(texts))]
    want = [plain_set(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in want]
    for i, j in combinations(range(len(texts)), 2):
        assert len(found[i] & found[j]) == len(want[i] & want[j])
    # A slice of a batch is read from its own offset.
    sliced = ngrams.ngram_sets(pa.array(texts, pa.string()).slice(8, 3), 4)
    assert [set(sliced[1][sliced[0] == i].tolist()) for i in range(3)] == found[8:11]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("salt_rows", [500, 6])
def test_groups_of_near_copies(spark, monkeypatch, salt_rows):
    monkeypatch.setattr(ngram_join, "SALT_ROWS", salt_rows)
    rng = random.Random(salt_rows)
    docs, at = [], 0
    common = [f"c{i}" for i in range(40)]
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 7, 9, 30, 120, 400]))]
        for _ in range(rng.choice([1, 4, 15])):
            text = edited(rng, base, rng.choice([0, 1, 1, 2, 4]))
            if rng.random() < 0.3:
                text += " " + " ".join(common)
            if rng.random() < 0.3:
                text = text.rsplit(" ", max(1, len(base) // 14))[0]
            docs.append((at, text))
            at += rng.choice([0, 1, 3])
    rng.shuffle(docs)
    check(spark, docs)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (6, "a b c"), (7, "a  b\tc"),
        (8, text), (8, text), (8, "other text of one id here"), (None, text + " w60"), (None, None),
        (None, "lonely words without any id"), (9, text.upper()), (10, text + " x y"), (11, "ab " * 90_000),
        (12, "ab " * 70_000), (13, "y" * 400_000), (14, "a b c d e f g h i"), (15, "a b c d e f g h i j"),
    ]
    check(spark, docs)
    check(spark, [(1, None), (2, "")])
    check(spark, [])


def test_a_chain_is_one_component(spark):
    """Each text is linked with the next only; no hub reaches them all."""
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(words[i * 6 : i * 6 + 100])) for i in range(40)]
    check(spark, docs)
    assert len({c for _, _, c in plain(docs)}) == 1


def test_fragments_follow_the_order():
    counts = np.random.default_rng(1).integers(0, 50, 1 << ngram_join.SLOT_BITS)
    place, fragment = global_order(counts)
    order = np.argsort(place)
    assert (np.diff(counts[order]) >= 0).all() and (np.diff(fragment[order].astype(int)) >= 0).all()
    weights = np.bincount(fragment, weights=counts, minlength=ngram_join.FRAGMENTS)
    assert weights.max() - weights.min() < 200


def test_whole_table(spark):
    name = "op13_ngram_jaccard"
    got = rows(QUERIES[name](spark, SF_DIR), "doc_id", "n_shingles", "component_id")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", F.col("text"))
    assert got == plain([tuple(r) for r in docs.collect()])


def scattered(rng, copies, words):
    """Copies of one text, two or three words changed: linked only if the changes lie close."""
    base = [f"w{i}" for i in range(words)]
    return [(i, edited(rng, base, rng.choice([2, 2, 3]))) for i in range(copies)]


def test_copies_that_are_not_linked_are_not_compared_in_pairs(spark, monkeypatch):
    """A large group's members that stay apart need few overlaps, not one per pair."""
    compared = []

    def counted(pairs, cut):
        compared.append(pairs.count())
        return whole(pairs, cut)

    whole = ngram_join.linked
    monkeypatch.setattr(ngram_join, "linked", counted)
    docs = scattered(random.Random(7), 300, 150)
    check(spark, docs)
    assert len({c for _, _, c in plain(docs)}) > 30
    assert sum(compared) < 300 * 299 / 2 / 4


@pytest.mark.parametrize("salt_rows", [500, 6])
def test_differences_from_a_hub_lose_no_link(spark, monkeypatch, salt_rows):
    """Without rounds of hubs all links of large groups come from the differences."""
    monkeypatch.setattr(ngram_join, "SALT_ROWS", salt_rows)
    monkeypatch.setattr(ngram_join, "HUB_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "HUB_MEMBERS", 3)
    rng = random.Random(salt_rows)
    docs, passage = [], [f"p{i}" for i in range(12)]
    for family in range(14):
        base = [f"f{family}w{i}" for i in range(rng.choice([6, 12, 40, 90]))]
        for _ in range(rng.choice([2, 9, 20])):
            words = edited(rng, base, rng.choice([0, 1, 2, 3, 5])).split()
            if rng.random() < 0.3:
                words = words[: max(1, len(words) - rng.randrange(12))]
            if rng.random() < 0.3:
                words[2:2] = passage[: rng.randrange(12)]
            docs.append((len(docs), " ".join(words)))
    check(spark, docs)
