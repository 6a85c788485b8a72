"""Refreshing stored facts against building them anew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from keystar.plans.marts import fact_interaction, fact_protein_disease
from keystar.plans.refresh import changed_rows, refresh_disease, refresh_interaction
from keystar.sources.keyed import BUCKET, bucket_of, read_keyed, replace_keys, write_keyed
from tests.conftest import rows

EDGES = "uniprot_a string, uniprot_b string, combined_score int"


def files(path):
    return {p.relative_to(path) for p in path.rglob("*.parquet")}


def test_changes_count_repeated_rows(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (4, "")], "k int, v string")
    new = spark.createDataFrame([("a", 1), (None, 2), ("d", 3), (None, 4), ("e", 5)], "v string, k int")
    assert rows(changed_rows(old, new, ["k"])) == [(1, -1), (3, -1), (3, 1), (4, -1), (4, 1), (5, 1)]
    assert rows(changed_rows(old, old, ["k"])) == []
    with pytest.raises(ValueError, match="columns differ"):
        changed_rows(old, new.drop("v"), ["k"])


@pytest.mark.parametrize("seed", [1, 2])
def test_interactions(spark, tmp_path, seed):
    rng = random.Random(seed)
    names = [f"P{i}" for i in range(40)]
    old = [(rng.choice(names), rng.choice([*names, "out", None]), rng.randrange(1000)) for _ in range(300)]
    new = [e for e in old if e[0] not in ("P3", "P4") or rng.random() < 0.5]
    new += [("P5", "P6", 999), ("P7", "P7", 5), ("P39", "P8", 1)]
    # The best edge of a pair goes: its score has to fall.
    old += [("P1", "P2", 2000)]
    dim = spark.createDataFrame([(n,) for n in names], "uniprot_accession string")
    before, after = spark.createDataFrame(old, EDGES), spark.createDataFrame(new, EDGES)
    path = tmp_path / "fact"
    write_keyed(fact_interaction(before, dim), str(path), ["uniprot_a"], 16)
    stored = files(path)
    touched = refresh_interaction(before, after, dim, str(path), 16)
    assert rows(read_keyed(spark, str(path))) == rows(fact_interaction(after, dim))
    changed = {str(p.parent) for p in stored ^ files(path)}
    assert changed and changed <= {f"{BUCKET}={n}" for n in touched} and len(touched) < 16
    # The same version again touches nothing.
    stored = files(path)
    assert refresh_interaction(after, after, dim, str(path), 16) == [] and files(path) == stored


def test_diseases(spark, tmp_path):
    rng = random.Random(5)
    targets = spark.createDataFrame(
        [(f"G{i}", f"P{i // 2}" if i % 5 else None) for i in range(30)], "ensembl_gene_id string, uniprot_accession string"
    )
    dim = spark.createDataFrame([(f"P{i}",) for i in range(12)], "uniprot_accession string")
    diseases = spark.createDataFrame([(f"E{i}", "n") for i in range(6)], "efo_id string, disease_name string")

    def frame(data):
        named = spark.createDataFrame(data, "ensembl_gene_id string, efo_id string, s double")
        return named.select("ensembl_gene_id", "efo_id", F.col("s").cast("decimal(10,6)").alias("overall_score"))

    old = [(f"G{rng.randrange(30)}", f"E{rng.randrange(7)}", round(rng.random(), 3)) for _ in range(150)]
    new = [(g, e, s) for g, e, s in old if g != "G7"] + [("G8", "E1", 0.999), ("G1", "E2", 0.01)]
    new = [(g, e, s / 2 if g == "G12" else s) for g, e, s in new]
    path = str(tmp_path / "fact")
    before, after = frame(old), frame(new)
    assert before.schema.simpleString().endswith("decimal(10,6)>")
    write_keyed(fact_protein_disease(before, targets, dim, diseases), path, ["uniprot_accession"], 8)
    refresh_disease(before, after, targets, dim, diseases, path, 8)
    want = fact_protein_disease(after, targets, dim, diseases)
    assert rows(read_keyed(spark, path), *want.columns) == rows(want)


def test_a_bucket_may_become_empty(spark, tmp_path):
    path = str(tmp_path / "store")
    data = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    write_keyed(data, path, ["k"], 64)
    number = data.where("k = 'b'").select(bucket_of(["k"], 64)).first()[0]
    gone = spark.createDataFrame([("b",), ("missing",)], "k string")
    assert number in replace_keys(spark, path, ["k"], 64, gone, data.limit(0))
    assert rows(read_keyed(spark, path)) == [("a", 1), ("c", 3)]
