"""The plans behind the operators: pruned scans, early limits, few exchanges, split hot keys."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from keystar.operators.composition import letter_composition
from keystar.operators.dedup import keep_first, pair_max, symmetric
from keystar.operators.ranking import top_n
from keystar.operators.resolve import resolve_ids, with_ends
from keystar.plans.lookup import box_around, search
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|SinglePartition)", plan(df)))


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_top_n_limits_before_its_shuffle(lines):
    text = plan(top_n(lines.select("l_partkey", "l_orderkey"), "l_partkey", 5, F.asc("l_orderkey")))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_keep_first_limits_before_its_shuffle(lines):
    kept = keep_first(lines.select("l_returnflag", "l_orderkey"), ["l_returnflag"], "l_orderkey")
    assert "Partial" in plan(kept) and exchanges(kept) == 1


def test_pair_max_scans_three_columns_and_combines_early(spark, lines):
    edges = lines.select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_quantity").alias("s"))
    keys = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey")
    text = plan(pair_max(edges, "a", "b", "s", keys))
    assert "partial_max" in text
    assert re.search(r"ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>", text)
    assert exchanges(pair_max(edges, "a", "b", "s", keys)) == 1


def test_composition_needs_no_shuffle(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    composed = letter_composition(documents, "doc_id", "text", "n_chars")
    assert "Exchange" not in plan(composed)
    assert "lang" not in plan(composed)


def test_symmetric_reads_the_edges_once(lines):
    both = symmetric(lines.select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey", "k", "o")
    assert plan(both).count("FileScan") == 1


def test_resolution_never_gathers_rows(spark):
    aliases = spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("user_id").alias("string_protein_id"), F.col("event_type").alias("alias"),
        F.lit("UniProt_AC").alias("source"), F.col("event_id").alias("ord"),
    )
    text = plan(resolve_ids(aliases))
    assert "collect_list" not in text and "partial_min" in text


def test_search_is_a_bounded_top_k(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    text = plan(search(part, "ring", symbol="p_brand", name="p_name", key="p_partkey"))
    assert "TakeOrderedAndProject" in text and "p_type" not in text


def test_box_uses_one_row_subqueries(spark):
    points = spark.range(10).select("id", F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    text = plan(box_around(points, "id", 3, "x", "y", 0.2))
    assert "Join" not in text and "ubquery" in text


def test_filters_reach_the_scan(lines):
    kept = lines.where(F.col("l_quantity") >= 50).select("l_partkey")
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,50.0)]" in plan(kept)


def test_a_hot_key_is_split_by_the_join(spark, tmp_path):
    """A third of the edges share one end; the shuffled join splits that partition."""
    n = 60_000
    edges = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("p"),
        F.lit("k1").alias("q"), F.col("id").alias("score"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    edges.repartition(16).write.parquet(str(tmp_path / "edges"))
    mapping = spark.range(n).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("accession"),
    ).union(spark.createDataFrame([("hot", "PHOT")], "id string, accession string"))
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        ends = with_ends(spark.read.parquet(str(tmp_path / "edges")), mapping, "p", "q")
        found = ends.groupBy(F.col("end_a") == "PHOT").agg(F.count("payload").alias("n"))
        result = dict(rows(found))
        assert result == {True: n // 3, False: n - n // 3}
        assert "skew=true" in plan(found)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
