"""SimHash groups against all pairs on small inputs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
import xxhash

from keystar.llm.simhash import BkTree, hamming_links, near_groups, simhash
from tests.conftest import rows


def plain_simhash(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values: dict[int, int], radius: int = 4) -> dict[int, int]:
    label = {i: i for i in values}
    changed = True
    while changed:
        changed = False
        for i, j in combinations(values, 2):
            if (values[i] ^ values[j]).bit_count() <= radius and label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return label


@pytest.mark.parametrize(
    "text", ["", " \t\n", "One", "a b c", "A B c D e", "É x y z \x0b w w w w w w", "ab " * 999]
)
def test_fingerprint(text):
    assert simhash(text.encode()) == plain_simhash(text)


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr("keystar.llm.simhash.HASHES", 7)
    text = " ".join(f"w{i % 11}{i}" for i in range(300))
    assert simhash(text.encode()) == plain_simhash(text)


@pytest.mark.parametrize("tree_rows", [200_000, 5])
def test_links_connect_what_all_pairs_connect(spark, tree_rows):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(40)]
    values = {0}
    for c in centres:
        for _ in range(12):
            for _ in range(rng.randrange(4)):
                c ^= 1 << rng.randrange(64)
            values.add(c)
    by_id = dict(enumerate(sorted(values)))
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in by_id.items()]
    links = hamming_links(spark.createDataFrame(signed, "fp long, rep long"), tree_rows).collect()
    assert all((by_id[a] ^ by_id[b]).bit_count() <= 4 for a, b in links)
    label = {i: i for i in by_id}
    for _ in by_id:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert label == plain_components(by_id)


def test_tree_skips_what_is_united():
    tree = BkTree()
    rng = random.Random(5)
    values = list({1 << rng.randrange(64) | 1 << rng.randrange(64) for _ in range(300)})
    assert sum(len(tree.add(v)) for v in values) == len(values) - 1


def test_groups_and_odd_rows(spark):
    base = " ".join(f"word{i}" for i in range(400))
    docs = [
        (5, base, "x", 1),
        (9, base.upper(), "x", 2),
        (7, base.replace("word200", "other"), "x", 3),
        (1, None, "x", 4),
        (3, "", None, 5),
        (2, " \n", "x", 6),
        (4, "entirely different words stand here", "x", 7),
        (4, "entirely different words stand here", "x", 7),
        (None, base, "x", 8),
        (None, "nobody knows this one text", None, 9),
        (8, "ab " * 50_000, "x", 10),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, fp string, component long")
    got = {}
    for i, fp, component in near_groups(frame).collect():
        got.setdefault(i, []).append((fp, component))
    values = {k: plain_simhash(t) for k, (_, t, _, _) in enumerate(docs)}
    label = plain_components(values)
    for k, (i, _, _, _) in enumerate(docs):
        ids = [docs[j][0] for j in label if label[j] == label[k] and docs[j][0] is not None]
        assert (f"{values[k]:016x}", min(ids, default=None)) in got[i]
    assert sum(map(len, got.values())) == len(docs)
    assert rows(near_groups(frame.limit(0))) == []


def test_whole_table(spark):
    from keystar.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    values = {i: plain_simhash(t) for i, t in docs.items()}
    label = plain_components(values)
    want = [(i, f"{values[i]:016x}", label[i]) for i in docs]
    assert rows(QUERIES["op1_simhash_near_dedup"](spark, sf)) == sorted(want, key=repr)


def test_one_id_on_unlike_texts_links_nothing(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(200)) for w in ("alpha", "beta", "gamma"))
    own = simhash(two.encode())
    near = next(
        t
        for t in (two + f" more{i} words{i} come{i}" for i in range(1000))
        if 0 < (simhash(t.encode()) ^ own).bit_count() <= 4
    )
    data = [(3, one), (3, two), (1, near), (5, three), (5, one), (6, three)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    want = {one: 3, two: 1, near: 1, three: 5}
    got = [(r.doc_id, r.component_id) for r in near_groups(frame).collect()]
    assert sorted(got) == sorted((i, want[t]) for i, t in data)
