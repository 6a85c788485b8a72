from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keystar.operators.dedup import (
    keep_first,
    max_evidence,
    ordered_distinct,
    pair_max,
    restrict_to,
    symmetric,
)
from keystar.operators.ranking import flatten_list, nest, top_n
from tests.conftest import rows


def test_pair_max_merges_directions_and_drops_self_pairs(spark):
    edges = spark.createDataFrame(
        [
            ("P01308", "P06213", 800),
            ("P06213", "P01308", 900),
            ("P01308", "P01308", 750),
            ("P01308", "X", 990),
            (None, "P01308", 990),
        ],
        "a string, b string, score int",
    )
    keys = spark.createDataFrame([("P01308",), ("P06213",)], "k string")
    assert rows(pair_max(edges, "a", "b", "score", keys)) == [("P01308", "P06213", 900)]
    only_b = spark.createDataFrame([("P06213",)], "k string")
    assert rows(pair_max(edges, "a", "b", "score", keys, only_b)) == [("P01308", "P06213", 800)]


def test_symmetric_sees_both_ends(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("a", "c", 2)], "x string, y string, s int")
    assert rows(symmetric(edges, "x", "y", "k", "o")) == [
        ("a", "b", 1), ("a", "c", 2), ("b", "a", 1), ("c", "a", 2),
    ]


def test_max_evidence_floor_is_inclusive(spark):
    evidence = spark.createDataFrame(
        [("G1", "D1", 0.09), ("G1", "D2", 0.10), ("G1", "D3", 0.5), ("G2", "D3", 0.7), ("G9", "D3", 0.9),
         ("G3", "D3", 0.9), ("G1", "D9", 0.9)],
        "gene string, disease string, score double",
    ).withColumn("score", F.col("score").cast("decimal(10,6)"))
    bridge = spark.createDataFrame(
        [("G1", "P1"), ("G2", "P1"), ("G3", "P3"), ("G4", None)], "gene string, acc string"
    )
    best = max_evidence(
        evidence, bridge, "gene", "acc", "disease", "score",
        anchors=spark.createDataFrame([("P1",)], "acc string"),
        subjects=spark.createDataFrame([("D1",), ("D2",), ("D3",)], "disease string"),
        floor=F.lit("0.1").cast("decimal(10,6)"),
    )
    got = [(a, d, float(s)) for a, d, s in rows(best)]
    assert got == [("P1", "D2", 0.1), ("P1", "D3", 0.7)]


@pytest.mark.parametrize("parts", [1, 5])
def test_keep_first_with_nulls_on_any_partitioning(spark, parts):
    data = [("a", 3, "late"), ("a", 1, "first"), (None, 2, "n1"), (None, 4, "n2"), ("b", 5, "only")]
    df = spark.createDataFrame(data, "k string, ord int, v string").repartition(parts)
    assert rows(keep_first(df, ["k"], "ord"), "k", "v") == [("a", "first"), ("b", "only"), (None, "n1")]


def test_ordered_distinct(spark):
    df = spark.createDataFrame(
        [("u", 4, "x"), ("u", 1, "z"), ("u", 2, "x"), ("u", 3, "z"), ("w", 1, "y")], "u string, t int, e string"
    ).repartition(3)
    assert rows(ordered_distinct(df, "u", "e", "t")) == [("u", ["z", "x"]), ("w", ["y"])]


def test_restrict_keeps_duplicates_once(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(restrict_to(df, keys, {"a": "k"})) == [(1,), (1,)]


def test_top_n_is_total_and_nested_in_order(spark):
    df = spark.createDataFrame(
        [("k", i, float(i % 3)) for i in range(9)] + [("m", 100, 1.0)], "k string, id int, s double"
    ).repartition(4)
    best = top_n(df, "k", 4, F.desc("s"), F.asc("id"))
    lists = dict(rows(nest(best, "k", ["id", "s"], "items")))
    assert [(i["id"], i["s"]) for i in lists["k"]] == [(2, 2.0), (5, 2.0), (8, 2.0), (1, 1.0)]
    flat = flatten_list(nest(best, "k", ["id", "s"], "items"), "k", "items")
    assert rows(flat) == [("k", 1, 2, 2.0), ("k", 2, 5, 2.0), ("k", 3, 8, 2.0), ("k", 4, 1, 1.0), ("m", 1, 100, 1.0)]
