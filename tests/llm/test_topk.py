"""Top-k search against sorting all scores."""

from __future__ import annotations

import math

import numpy as np
import pytest

from keystar.llm import topk
from keystar.llm.topk import products, tile_top, top_k
from tests.conftest import rows

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def plain(queries, candidates, k):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    def cells(v):
        return [math.floor(256 * float(np.float32(x))) for x in v]

    found = []
    asked = {(i, tuple(v)) for i, v in queries if i is not None and usable(v)}
    for i, v in asked:
        scored = sorted(
            (-sum(a * b for a, b in zip(cells(v), cells(w), strict=True)), j)
            for j, w in candidates
            if j is not None and j != i and usable(w) and len(w) == len(v)
        )
        found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(found, key=repr)


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 3)
    monkeypatch.setattr(topk, "SCORES", 4)
    same = [0.5, -0.25]
    data = [
        (0, same), (1, same), (2, same), (3, same), (4, [0.1, 0.9]), (5, None), (6, [None, 1.0]),
        (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]), (9, [1.0]), (10, [1.0]), (None, same),
        (11, []), (12, []), (13, [3e4, -2e5]), (14, [1e9, 1e9]), (14, [1e9, 1e9]), (0, same),
    ]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in data], SCHEMA)
    for k in (2, 5):
        assert rows(top_k(frame, frame, k)) == plain(data, data, k)
    assert rows(top_k(frame.limit(0), frame)) == rows(top_k(frame, frame.limit(0))) == []


@pytest.mark.parametrize("size", [1.0, 1e5, 1e12])
def test_products_are_exact(size):
    rng = np.random.default_rng(1)
    left, right = (np.floor(rng.normal(size=(5, 7)) * size) for _ in range(2))
    want = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in right] for x in left]
    clipped = [[max(min(v, 2**63 - 1), -(2**63)) for v in row] for row in want]
    assert [[int(v) for v in row] for row in products(left, right)] == clipped


def test_ties_within_a_tile():
    ids = np.arange(50)
    got = list(tile_top(np.array([7]), np.ones((1, 2)), ids, np.ones((50, 2)), 5))
    assert got == [(7, i, 2) for i in range(5)]
