"""Walks over links against plain Python walks."""

from __future__ import annotations

import random

import pytest

from keystar.operators import graph
from keystar.operators.graph import follow_forwards, forwarded, forwarded_unique, reached_from
from keystar.plans.diseases import disease_areas, nearest_area, read_disease_terms
from tests.conftest import rows

LINKS = "old string, new string"


def plain_reach(edges, roots):
    found = {}
    for root in {r for r in roots if r}:
        level, distance = {root}, 0
        while level:
            for node in level:
                found.setdefault((node, root), distance)
            distance += 1
            level = {c for c, p in edges if p in level and c and (c, root) not in found}
    return sorted(((n, r, d) for (n, r), d in found.items()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_reach_on_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(25)}", f"n{rng.randrange(25)}") for _ in range(40)]
    edges += [(None, "n1"), ("n2", None), ("n3", "n3"), edges[0]]
    roots = ["n1", "n5", "n5", "away", None]
    got = reached_from(
        spark.createDataFrame(edges, "child string, parent string"),
        spark.createDataFrame([(r,) for r in roots], "root string"),
    )
    assert rows(got) == plain_reach(edges, roots)


def test_reach_of_nothing(spark):
    edges = spark.createDataFrame([], "child string, parent string")
    assert rows(reached_from(edges, spark.createDataFrame([], "root string"))) == []
    assert rows(reached_from(edges, spark.createDataFrame([("a",)], "root string"))) == [("a", "a", 0)]


def test_areas(spark, tmp_path):
    terms = [
        ("top", []), ("other", None), ("a", ["top"]), ("b", ["a", "other"]), ("c", ["b", "b", "missing"]),
        ("d", ["missing"]), ("x", ["y"]), ("y", ["x"]), ("z", ["x"]), ("w", ["x", "a"]), ("self", ["self"]),
    ]
    written = spark.createDataFrame(terms, "id string, parents array<string>")
    written.write.parquet(str(tmp_path / "terms"))
    areas = disease_areas(read_disease_terms(spark, str(tmp_path / "terms")))
    assert rows(areas) == sorted([
        ("top", "top", 0), ("other", "other", 0), ("a", "top", 1), ("b", "top", 2), ("b", "other", 1),
        ("c", "top", 3), ("c", "other", 2), ("d", "d", 0), ("self", "self", 0), ("w", "top", 2),
    ], key=repr)
    names = spark.createDataFrame([("top", "Top"), ("other", None)], "efo_id string, disease_name string")
    assert dict(rows(nearest_area(areas, names))) == {
        "top": "Top", "other": "other", "a": "Top", "b": "other", "c": "other", "d": "d",
        "self": "self", "w": "Top",
    }


def plain_ends(links, current):
    step = {}
    for old, new in links:
        if old and new and old != new and old not in current:
            step.setdefault(old, set()).add(new)
    found = []
    for start in step:
        seen, pending, circle = set(), [start], False
        while pending:
            for new in step.get(pending.pop(), ()):
                if new not in seen:
                    seen.add(new)
                    pending.append(new)
        ends = sorted(seen & current)
        for node in seen & step.keys():
            below, pending = set(), [node]
            while pending:
                for new in step.get(pending.pop(), ()):
                    if new not in below:
                        below.add(new)
                        pending.append(new)
            circle |= node in below
        status = "resolved" if len(ends) == 1 else "split" if ends else "cycle" if circle else "gone"
        found.append((start, ends[0] if len(ends) == 1 else None, len(ends), status))
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_forwards_on_random_links(spark, seed):
    rng = random.Random(seed)
    current = {f"n{i}" for i in range(0, 40, 7)}
    links = [(f"n{rng.randrange(40)}", f"n{rng.randrange(50)}") for _ in range(35)]
    links += [(None, "n1"), ("n2", None), links[0]]
    got = follow_forwards(
        spark.createDataFrame(links, LINKS),
        spark.createDataFrame([(c,) for c in [*current, None]], "id string"),
    )
    assert rows(got) == plain_ends(links, current)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    real = graph.stash
    monkeypatch.setattr(graph, "stash", lambda df, name: written.append(name) or real(df, name))
    links = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(1000)], LINKS)
    got = follow_forwards(links, spark.createDataFrame([("n1000",)], "id string"))
    assert got.where("resolved = 'n1000' AND status = 'resolved'").count() == 1000
    assert written.count("walks") <= 12


def test_forwarded_rows(spark):
    resolution = spark.createDataFrame(
        [("o1", "p1", 1, "resolved"), ("o2", "p1", 1, "resolved"), ("o3", None, 2, "split"), ("o4", "p4", 1, "resolved")],
        "id string, resolved string, targets long, status string",
    )
    edges = spark.createDataFrame([("o1", "p9", 1), ("p1", "o3", 2), (None, "o2", 3)], "a string, b string, s int")
    assert rows(forwarded(edges, resolution, "a", "b")) == sorted(
        [("p1", "p9", 1), ("p1", "o3", 2), (None, "p1", 3)], key=repr
    )
    notes = spark.createDataFrame(
        [(1, "o1", "old"), (2, "p1", None), (3, "o4", "b"), (4, "o2", "older"), (5, None, "c")],
        "n int, acc string, note string",
    )
    assert rows(forwarded_unique(notes, resolution, "acc")) == [(2, "p1", None), (3, "p4", "b")]
    assert rows(forwarded(edges, resolution.limit(0), "a")) == rows(edges)
