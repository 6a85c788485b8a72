from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from keystar.functions.vectors import cosine
from keystar.operators import neighbors as N
from keystar.operators.ranking import top_n
from tests.conftest import rows


def frame(spark, vectors, ids=None, kind="long"):
    ids = list(range(len(vectors))) if ids is None else ids
    data = [(i, None if v is None else [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(data, f"id {kind}, v array<float>").repartition(3)


def by_pairs(df, k):
    """The same from every row pair."""
    left = df.select("id", F.col("v").alias("a"))
    right = df.select(F.col("id").alias("neighbor"), F.col("v").alias("b"))
    scored = left.join(right, F.col("id") != F.col("neighbor")).select(
        "id", "neighbor", F.round(cosine(F.col("a"), F.col("b")), 6).alias("similarity")
    )
    return top_n(scored, "id", k, F.desc("similarity"), F.asc("neighbor"))


def random_vectors(n, dim=8, seed=0):
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)


def clustered(n, centers=6, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(centers, dim))
    return (middles[rng.integers(centers, size=n)] + 0.01 * rng.normal(size=(n, dim))).astype(np.float32)


def test_ranked_without_self(spark):
    df = frame(spark, [[1, 0], [0.9, 0.1], [0, 1]], ["a", "b", "c"], "string")
    assert [(r["id"], r["neighbor"], r["rank"]) for r in N.cosine_topk(df, "id", "v", 2).orderBy("id", "rank").collect()] == [
        ("a", "b", 1), ("a", "c", 2), ("b", "a", 1), ("b", "c", 2), ("c", "b", 1), ("c", "a", 2),
    ]


def test_k_is_clipped_and_length_is_ignored(spark):
    got = N.cosine_topk(frame(spark, [[1, 2], [2, 4]]), "id", "v", 20).collect()
    assert [(r["similarity"], r["rank"]) for r in got] == [(1.0, 1), (1.0, 1)]


def test_single_row_no_rows_and_directionless_rows(spark):
    assert N.cosine_topk(frame(spark, [[1, 2]]), "id", "v").count() == 0
    assert N.cosine_topk(frame(spark, []), "id", "v").count() == 0
    got = rows(N.cosine_topk(frame(spark, [[1, 0], [0, 0], None, [1, 1], [float("nan"), 1], [float("inf"), 0]]), "id", "v"), "id", "neighbor")
    assert got == [(0, 3), (3, 0)]


@pytest.mark.parametrize("data", ["random", "clustered", "copies"])
@pytest.mark.parametrize("strip", [16, 64, None])
def test_equal_to_all_pairs(spark, data, strip, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 32)
    vectors = {
        "random": lambda: random_vectors(150),
        "clustered": lambda: clustered(150),
        # A third of the rows are copies of one vector: ties at every rank.
        "copies": lambda: np.vstack([random_vectors(100), np.tile(random_vectors(1, seed=9), (50, 1))]),
    }[data]()
    df = frame(spark, vectors)
    got = N.cosine_topk(df, "id", "v", 7, strip_rows=strip)
    assert rows(got) == rows(by_pairs(df, 7), "id", "neighbor", "similarity", "rank")


@pytest.mark.parametrize("block", [1, 3, 8, 100])
def test_running_lists(block, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    rng = np.random.default_rng(block)
    left, right = (np.round(rng.normal(size=(n, 2)), 1) + 0.05 for n in (23, 31))
    left, right = (m / np.linalg.norm(m, axis=1)[:, None] for m in (left, right))
    one, two = N.pair_topk(left, right, 4)
    for (row, at, score), a, b in ((one, left, right), (two, right, left)):
        scores = np.rint(a @ b.T * N.SCALE)
        for r in range(len(a)):
            want = sorted((-s, c) for c, s in enumerate(scores[r]))[:4]
            assert list(zip(-score[row == r], at[row == r])) == want


def test_rows_travel_to_as_many_tasks_as_there_are_strips(spark):
    df = frame(spark, random_vectors(200)).withColumnRenamed("v", "vector")
    for strips in (3, 6):
        dealt = N._dealt(df, strips)
        assert dealt.count() == 200 * strips
        assert dealt.select("a", "b").distinct().count() == strips * (strips + 1) // 2


def test_strips_follow_the_rows(spark):
    df = spark.range(1)
    assert N._strips(df, 10**6, 1000, None) == 120
    assert N._strips(df, 10**8, 1000, None) == 11922
    assert N._strips(df, 100, 8, None) == 3


def test_small_strips_do_not_copy_rows_more_often(spark, monkeypatch):
    dealt, deal = [], N._dealt
    monkeypatch.setattr(N, "_dealt", lambda rows, strips: dealt.append(strips) or deal(rows, strips))
    df = frame(spark, random_vectors(300))
    got = N.cosine_topk(df, "id", "v", 5, strip_rows=2)
    assert rows(got) == rows(N.cosine_topk(df, "id", "v", 5))
    assert dealt == [3, 3]


def test_few_blocks_are_taken_in_double_precision(monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    taken, block = [], N._block
    monkeypatch.setattr(N, "_block", lambda left, right: taken.append(len(left) * len(right)) or block(left, right))
    left, right = (m / np.linalg.norm(m, axis=1)[:, None] for m in (random_vectors(1024, 16, s).astype(float) for s in (3, 4)))
    one, two = N.pair_topk(left, right, 2)
    assert sum(taken) < len(left) * len(right) / 4
    scores = np.rint(left @ right.T * N.SCALE)
    for (row, at, score), want in ((one, scores), (two, scores.T)):
        order = np.lexsort((np.broadcast_to(np.arange(1024), want.shape), -want), axis=1)[:, :2]
        assert np.array_equal(at.reshape(-1, 2), order)
        assert np.array_equal(score.reshape(-1, 2), np.take_along_axis(want, order, axis=1))


@pytest.mark.parametrize("cells", [7, 64, 4096])
def test_set_cells_of_a_mask(cells):
    mask = np.random.default_rng(cells).random(cells) < 0.1
    assert np.array_equal(N._few(mask), np.flatnonzero(mask))


def test_pairs_of_strips_have_a_partition_each(spark):
    df = frame(spark, random_vectors(200)).withColumnRenamed("v", "vector")
    found = N._compare(N._dealt(df, 6), 6, 3, df.schema["id"].dataType)
    assert found.rdd.getNumPartitions() == 21
    assert all(found.rdd.mapPartitions(lambda rows: [any(True for _ in rows)]).collect())
