"""The whole star: on zero rows, on a hand-made source set, and written as tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from keystar import schemas
from keystar.operators import quality as Q
from keystar.operators.ranking import top_n
from keystar.plans import checks as C
from keystar.plans import marts, staging
from keystar.plans.cards import story_cards
from keystar.plans.warehouse import build_star, load_bronze, load_tables, write_marts
from keystar.sources import storage
from tests.conftest import rows


@pytest.fixture(scope="module")
def bronze(spark):
    def make(name, data):
        return spark.createDataFrame(data, schemas.BRONZE[name])

    def entry(key, symbol, seq, text):
        return (key, [], symbol, f"name {key}", len(seq), seq, text, [], ["PF1", "PF2"], [f"G{key}"], [])

    return {
        "uniprot": make("uniprot", [
            entry("P1", "A", "ACDACA", "raw one"), entry("P2", "B", "MKU", None), entry("P3", None, "W", "raw three"),
        ]),
        "string": make("string", [("P1", "P2", 800), ("P2", "P1", 900), ("P1", "P1", 950), ("P1", "P9", 999)]),
        "hpa": make("hpa", [
            ("A", "P1", "Plasma proteins, Enzymes,Predicted secreted proteins", "enhanced", "single", "Golgi", None),
            ("B", "P2", "Cancer-related genes", None, None, None, None),
            ("X", None, "Enzymes", None, None, None, None),
            ("Y", "P9", "Enzymes", None, None, None, None),
        ]),
        "ot_targets": make("ot_targets", [
            ("G1", "A", "a", [("uniprot_trembl", "T1"), ("uniprot_swissprot", "P1"), ("uniprot_swissprot", "P2")]),
            ("G2", "A2", "copy", [("uniprot_swissprot", "P1")]),
            ("G3", "N", "none", None),
            ("G4", "T", "other", [("uniprot_trembl", "T4")]),
            ("G9", "Z", "unknown", [("uniprot_swissprot", "P9")]),
        ]),
        "ot_diseases": make("ot_diseases", [("E1", "one"), ("E2", "two"), (None, "x"), ("E3", None)]),
        "ot_associations": make("ot_associations", [
            ("E1", "G1", 0.09), ("E1", "G2", 0.3), ("E2", "G1", 0.1), ("E2", "G9", 0.9), ("E3", "G1", 0.9), ("E2", "G3", 0.9),
        ]),
        "ot_drugs": make("ot_drugs", [
            ("C1", "G1", [("d", "E1"), ("d", None)], "PHASE_3"),
            ("C1", "G2", [("other", "E1")], "PHASE_2_3"),
            ("C2", "G1", None, "UNKNOWN"),
            ("C3", "G9", [("d", "E1")], "APPROVAL"),
            ("C4", "G1", [("d", "E9")], "NEW STAGE"),
        ]),
        "ot_drug_molecules": make("ot_drug_molecules", [("C1", "drug one", "Small molecule"), (None, "x", "y")]),
        "llm_rewrites": make("llm_rewrites", [("P1", "written one", "tag one"), ("P2", "written two", None), ("P3", None, None)]),
    }


@pytest.fixture(scope="module")
def star(spark, bronze):
    editorial = spark.createDataFrame(
        [("P1", "fast�slow", None, True), ("P9", "t", "f", True)], schemas.SEED_EDITORIAL
    )
    return build_star(spark, bronze, editorial)


def test_staging(star):
    assert rows(star["stg_uniprot"], "uniprot_accession", "pfam_id", "string_protein_id") == [
        ("P1", "PF1", None), ("P2", "PF1", None), ("P3", "PF1", None),
    ]
    assert rows(star["stg_ot_targets"], "ensembl_gene_id", "uniprot_accession") == [
        ("G1", "P1"), ("G2", "P1"), ("G3", None), ("G4", None), ("G9", "P9"),
    ]
    assert star["stg_hpa"].count() == 3
    assert star["stg_ot_diseases"].count() == 2
    assert star["stg_ot_drug_molecules"].count() == 1


def test_protein_texts_fall_through_the_ladder(star):
    got = rows(star["dim_protein"], "uniprot_accession", "function_raw", "function_friendly", "tagline", "is_curated", "family_group")
    nothing = "No information available"
    assert got == [
        ("P1", "raw one", "written one", "fast—slow", True, "Enzymes"),
        ("P2", nothing, "written two", nothing, False, "Unclassified"),
        ("P3", "raw three", "raw three", nothing, False, "Unclassified"),
    ]
    assert star["dim_protein"].columns == [
        "uniprot_accession", "gene_symbol", "protein_name", "sequence_length", "sequence", "pfam_id", "function_raw",
        "function_friendly", "tagline", "is_curated", "ensembl_gene_id", "string_protein_id", "chembl_target_id",
        "protein_class", "subcellular_location", "family_group", "updated_at",
    ]


def test_dimensions(star):
    assert rows(star["dim_disease"]) == [("E1", "one", None), ("E2", "two", None)]
    assert rows(star["dim_drug"]) == [
        ("C1", "drug one", 3, "Small molecule"), ("C2", None, None, None), ("C3", None, 4, None), ("C4", None, None, None),
    ]


def test_facts(star):
    assert rows(star["fact_interaction"]) == [("P1", "P2", 900)]
    assert [(a, e, float(s)) for a, e, s in rows(star["fact_protein_disease"])] == [("P1", "E1", 0.3), ("P1", "E2", 0.1)]
    assert rows(star["fact_drug_target_disease"]) == [
        ("C1", "P1", "E1", None), ("C1", "P1", None, None), ("C4", "P1", "E9", None),
    ]
    assert rows(star["fact_protein_tissue"]) == [("P1", "enhanced", "single"), ("P2", None, None)]
    letters = {(r[0], r[1]): (r[2], r[3]) for r in star["fact_protein_aa_composition"].collect()}
    assert len(letters) == 60
    assert letters[("P1", "A")] == (3, 50.0) and letters[("P1", "C")] == (2, 33.33)
    assert sum(n for (p, _), (n, _) in letters.items() if p == "P2") == 2


def test_checks_on_the_star(star):
    found = {name: n for name, n in rows(Q.summarize(C.star_checks(), star)) if n}
    # Seed notes are the user's; C4's disease and stage are unknown; three proteins are few.
    assert found == {
        "accepted_stages": 1,
        "relationships_fact_drug_target_disease_efo_id": 1,
        "protein_volume": 1,
        "family_group_valid": 1,
    }


def test_zero_rows(spark):
    empty = build_star(
        spark,
        storage.empty_sources(spark),
        spark.createDataFrame([], schemas.SEED_EDITORIAL),
        model=(lambda: lambda texts: np.zeros((len(texts), 2), np.float32), "none"),
    )
    for name in empty:
        if name.startswith(("stg_", "dim_", "fact_")):
            assert empty[name].count() == 0, name
    assert story_cards(empty).count() == 0
    untagged = Q.select_checks(C.star_checks(), exclude=[Q.REAL_DATA])
    found = {name: n for name, n in rows(Q.summarize(untagged, empty)) if n}
    assert found == {}
    Q.require(untagged, empty)
    with pytest.raises(ValueError, match=r"not_null_seed_amino_acids_description \(20\)"):
        Q.require([*untagged, C.described_seed()], empty)
    for name in empty:
        if not name.startswith("stg_"):
            assert Q.schema_differences(empty[name], schemas.MARTS[name]) == [], name


def test_landed_bronze_to_tables(spark, bronze, star, tmp_path):
    for name, path in storage.bronze_paths(str(tmp_path)).items():
        storage.write_parquet(bronze[name], path)
    landed = load_bronze(spark, str(tmp_path))
    for name, df in landed.items():
        assert Q.schema_differences(df, schemas.BRONZE[name]) == []
    rebuilt = build_star(spark, landed, star["dim_protein_editorial"])
    spark.sql("CREATE DATABASE IF NOT EXISTS star_test")
    tables = write_marts(rebuilt, "star_test")
    assert len(tables) == 12
    assert rows(spark.table("star_test.fact_interaction")) == [("P1", "P2", 900)]
    write_marts(rebuilt, "star_test", buckets=4)
    assert spark.table("star_test.dim_protein").count() == 3
    # Stored by key: the top-N window over the fact needs no shuffle.
    saved = load_tables(spark, tables)
    best = top_n(saved["fact_protein_disease"], "uniprot_accession", 5, F.desc("overall_score"), F.asc("efo_id"))
    assert "Exchange" not in best._jdf.queryExecution().executedPlan().toString()
    served = story_cards(saved)
    assert rows(served, "uniprot_accession", F.size("top_diseases")) == [("P1", 2), ("P2", 0), ("P3", 0)]


def test_best_group_ignores_unnamed_groups(spark):
    df = spark.createDataFrame([("k", "a, b")], "k string, labels string")
    groups = spark.createDataFrame([("a", None, 1), ("b", "B", 2)], "label string, grp string, priority int")
    assert rows(marts.best_group(df, "k", "labels", groups)) == [("k", "B")]


def test_every_staging_view_has_a_source():
    assert {source for source, _ in staging.STAGING.values()} == set(schemas.BRONZE)
