"""Search over cells against all products."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from keystar.operators import cells as C
from keystar.operators.cells import build_index, fit_centroids, search
from keystar.operators.neighbors import cosine_topk
from tests.conftest import rows

SCHEMA = "id long, v array<float>"


def plain(data, queries, k):
    usable = [(i, np.array(v, dtype=float)) for i, v in data if v and all(x is not None and np.isfinite(x) for x in v)]
    usable = [(i, v / np.linalg.norm(v)) for i, v in usable if np.any(v)]
    found = []
    for q, w in queries:
        if not w or not np.any(w):
            continue
        w = np.array(w, dtype=float) / np.linalg.norm(w)
        scored = sorted((-round(float(np.rint(w @ v * 1e6)) / 1e6, 6), i) for i, v in usable)
        found += [(q, i, -s, r) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    x = centres[rng.integers(0, 12, n)] + rng.normal(scale=0.3, size=(n, 8))
    return [(i, row) for i, row in enumerate(x.astype(np.float32).round(3).tolist())]


@pytest.mark.parametrize("block_rows", [50_000, 20])
def test_all_cells_are_exact(spark, monkeypatch, block_rows):
    monkeypatch.setattr(C, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(C, "QUERY_ROWS", 16)
    data = clustered(300, 1)
    data += [(1000, data[3][1]), (1001, data[3][1]), (1002, None), (1003, [0.0] * 8), (1004, [None] * 8)]
    queries = [(i, np.roll(v, 1).tolist()) for i, v in data[:40]] + [(99, None), (98, [0.0] * 8)]
    index = build_index(spark.createDataFrame(data, SCHEMA), "id", "v", cells=9)
    assert index.rows(spark).count() == 302
    asked = spark.createDataFrame(queries, "q long, w array<double>")
    got = rows(search(index, asked, "q", "w", 7), "query_id", "id", "similarity", "rank")
    assert got == plain(data, queries, 7)


def test_some_cells_find_most(spark):
    data = clustered(3000, 2)
    frame = spark.createDataFrame(data, SCHEMA)
    index = build_index(frame, "id", "v", cells=40)
    asked = frame.where("id % 10 = 0")
    exact = search(index, asked, "id", "v", 10)
    some = search(index, asked, "id", "v", 10, probes=8)
    hits = exact.join(some, ["query_id", "id"], "left_semi").count()
    assert hits >= 0.9 * exact.count() and some.count() == exact.count()


def test_the_exact_way_agrees_with_all_neighbours(spark):
    frame = spark.createDataFrame(clustered(200, 3), SCHEMA)
    found = search(build_index(frame, "id", "v"), frame, "id", "v", 6)
    others = found.where("query_id <> id").select("query_id", F.col("id").alias("neighbor"), "similarity")
    want = cosine_topk(frame, "id", "v", 5).select(F.col("id").alias("query_id"), "neighbor", "similarity")
    assert set(rows(want)) <= set(rows(others))


def test_unread_cells_are_pruned(spark):
    frame = spark.createDataFrame(clustered(2000, 4), SCHEMA)
    index = build_index(frame, "id", "v", cells=20)
    read = index.rows(spark).where("cell IN (3)").inputFiles()
    assert read and len(index.rows(spark).where("cell = 3").select("id").collect()) < 2000
    one = search(index, frame.limit(1), "id", "v", 5, probes=1)
    assert "dynamicpruning" in one._jdf.queryExecution().optimizedPlan().toString().lower() or one.count() == 5


def test_the_sample_is_bounded_and_the_same(spark):
    data = clustered(500, 5)
    units = spark.createDataFrame(data, "id long, unit array<double>")
    first = fit_centroids(units.repartition(3), 10, sample_rows=100)
    second = fit_centroids(units.repartition(7, "unit"), 10, sample_rows=100)
    assert first.shape == (10, 8) and np.array_equal(first, second)


def test_nothing_to_index(spark):
    empty = spark.createDataFrame([], SCHEMA)
    index = build_index(empty, "id", "v")
    assert rows(search(index, spark.createDataFrame([(1, [1.0])], SCHEMA), "id", "v")) == []
    with pytest.raises(ValueError, match="2 to 3"):
        build_index(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])], SCHEMA), "id", "v")


@pytest.mark.parametrize("probes", [None, 28])
def test_queries_travel_once_to_a_group_of_cells(spark, monkeypatch, probes):
    sent, compare = [], C._compare
    monkeypatch.setattr(C, "_compare", lambda many, asked, *more: sent.append((many, asked)) or compare(many, asked, *more))
    frame = spark.createDataFrame(clustered(1600, 6), SCHEMA)
    index = build_index(frame, "id", "v", cells=40)
    asked = frame.where("id % 5 = 0")
    found = search(index, asked, "id", "v", 5, probes=probes)
    assert found.count() == 320 * 5
    many, queries = sent[0]
    # One strip of queries and some eight groups for four cores, where there are 40 cells.
    assert many.count() <= 2 * 1600 and queries.count() <= 320 * 12


def test_equal_scores_of_several_cells_go_to_the_smaller_id(spark):
    data = [(i, [1.0, 0.002 * (i % 9), 0.0]) for i in range(400)] + [(1000 + i, [1.0, 0.0, 0.001 * i]) for i in range(9)]
    frame = spark.createDataFrame(data, SCHEMA)
    index = build_index(frame, "id", "v", cells=12)
    asked = [(1, [1.0, 0.001, 0.001]), (2, [1.0, 0.0, 0.0])]
    some = search(index, spark.createDataFrame(asked, SCHEMA), "id", "v", 60, probes=len(index.centroids) - 1)
    cells = {r["id"]: r["cell"] for r in index.rows(spark).select("id", "cell").collect()}
    near = {q: np.argsort(-(index.centroids @ np.array(v)), kind="stable")[:-1] for q, v in asked}
    want = [r for q, v in asked for r in plain([d for d in data if cells[d[0]] in near[q]], [(q, v)], 60)]
    assert rows(some, "query_id", "id", "similarity", "rank") == sorted(want, key=repr)


def test_large_cells_lie_in_several_groups():
    first, parts, members = C._groups(np.array([0, 3, 25, 0, 4, 4, 9]), 10)
    assert parts.tolist() == [1, 1, 3, 1, 1, 1, 1] and sorted({c for m in members for c in m.tolist()}) == list(range(7))
    assert all(cell in members[f + p] for cell, (f, n) in enumerate(zip(first, parts)) for p in range(n))


def test_an_index_has_a_file_per_cell(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(C, "BLOCK_ROWS", 50)
    frame = spark.createDataFrame(clustered(3000, 7), SCHEMA)
    index = build_index(frame, "id", "v", cells=20, path=str(tmp_path / "index"))
    assert len(list((tmp_path / "index").glob("cell=*/*.parquet"))) <= 20
    assert index.sizes.sum() == 3000


def test_texts_are_dealt_out_as_far_as_the_model_reads(spark, monkeypatch, tmp_path):
    from workload import vectors as V

    dealt, spread = [], V.spread
    monkeypatch.setattr(V, "spread", lambda df, n: dealt.append(df) or spread(df, n))
    texts = [(i, "abc xyz "[: 1 + i % 8] * (1 + 40 * i)) for i in range(1, 120)] + [(50 * 7, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = rows(V.text_search(spark, str(tmp_path)), "query_id", "rank", "similarity")
    assert [r[:2] for r in found] == [(f"new {i}", r) for i in (100, 50) for r in range(1, 6)]
    assert all(r[2] == 1.0 for r in found if r[1] == 1)
    assert dealt[0].selectExpr("max(length(text))").first()[0] == 1022
