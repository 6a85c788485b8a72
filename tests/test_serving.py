"""Cards and lookups on a small warehouse: a ligand, its receptor and a relative."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.plans import cards, lookup
from keystar.plans.marts import ANCHOR, amino_acids
from tests.conftest import rows

PROTEIN = (
    "uniprot_accession string, gene_symbol string, protein_name string, sequence_length int, sequence string, "
    "pfam_id string, function_raw string, function_friendly string, tagline string, is_curated boolean, "
    "protein_class string, subcellular_location string, family_group string"
)


def protein(key, symbol, name, length, family):
    return (key, symbol, name, length, "MKV", "PF1", "raw", "text", "tag", True, "class", "loc", family)


@pytest.fixture(scope="module")
def warehouse(spark):
    make = spark.createDataFrame
    return {
        "dim_protein": make(
            [
                protein("P01308", "INS", "Insulin", 110, "Secreted"),
                protein("P06213", "INSR", "Insulin receptor", 1382, "Enzymes"),
                protein("P08069", "IGF1R", "Insulin-like growth factor 1 receptor", 1367, "Enzymes"),
            ],
            PROTEIN,
        ),
        "fact_protein_tissue": make(
            [("P01308", "Tissue enhanced (pancreas)", "Detected in single")],
            "uniprot_accession string, tissue string, expression_level string",
        ),
        "fact_interaction": make(
            [("P01308", "P06213", 999), ("P01308", "P08069", 990)],
            "uniprot_a string, uniprot_b string, combined_score int",
        ),
        "dim_disease": make([("E1", "type 1 diabetes (juvenile)")], "efo_id string, disease_name string"),
        "fact_protein_disease": make(
            [("P01308", "E1", 0.9), ("P06213", "E1", 0.5)],
            "uniprot_accession string, efo_id string, overall_score double",
        ).withColumn("overall_score", F.col("overall_score").cast("decimal(10,6)")),
        "dim_drug": make(
            [("C1", "Insulin glargine", 4), ("C2", None, 3), ("C3", "Early", 2), ("C4", "Unknown", None)],
            "chembl_id string, drug_name string, max_phase int",
        ),
        "fact_drug_target_disease": make(
            [("C1", "P06213", "E1"), ("C1", "P06213", None), ("C2", "P06213", "E1"), ("C3", "P06213", "E1"),
             ("C4", "P06213", "E1")],
            "chembl_id string, uniprot_accession string, efo_id string",
        ),
        "fact_embedding": make(
            [("P01308", 1.0, 2.0), ("P06213", 1.1, 2.1), ("P08069", 1.2, 2.2)],
            "uniprot_accession string, umap_x float, umap_y float",
        ),
        "fact_protein_neighbor": make(
            [("P01308", "P08069", 0.91, 2), ("P01308", "P06213", 0.96, 1), ("P01308", "GONE", 0.5, 3)],
            "uniprot_accession string, neighbor_accession string, similarity float, rank int",
        ),
    }


def card(spark, warehouse, key):
    keys = spark.createDataFrame([(key,)], "k string")
    return cards.story_cards(warehouse, keys).first()


def test_ligand_has_partners_but_no_drug(spark, warehouse):
    c = card(spark, warehouse, "P01308")
    assert (c["gene_symbol"], c["family_group"], c["sequence"]) == ("INS", "Secreted", "MKV")
    assert c["tissue_specificity"] == "Tissue enhanced (pancreas)"
    assert [(p["accession"], p["gene_symbol"], p["combined_score"]) for p in c[cards.PARTNERS]] == [
        ("P06213", "INSR", 0.999), ("P08069", "IGF1R", 0.99),
    ]
    assert c[cards.DRUGS] == []
    assert c[cards.DISEASES][0].asDict() == {
        "efo_id": "E1", "disease_name": "type 1 diabetes (juvenile)", "overall_score": 0.9,
    }


def test_receptor_carries_the_drugs(spark, warehouse):
    c = card(spark, warehouse, "P06213")
    assert [(d["chembl_id"], d["max_phase"]) for d in c[cards.DRUGS]] == [("C1", 4), ("C2", 3)]
    assert [p["accession"] for p in c[cards.PARTNERS]] == ["P01308"]
    assert c["tissue_specificity"] is None


def test_unknown_key_and_all_cards(spark, warehouse):
    assert card(spark, warehouse, "X99999") is None
    all_cards = cards.story_cards(warehouse)
    assert all_cards.count() == 3
    assert [c for c in all_cards.columns if c not in cards.CARD_COLUMNS] == [
        "tissue_specificity", "tissue_distribution", cards.PARTNERS, cards.DISEASES, cards.DRUGS,
    ]


def test_lists_are_limited_with_ties_by_key(spark, warehouse):
    hub = [("P01308", f"X{i:02d}", 900) for i in range(30)]
    tables = {
        **warehouse,
        "dim_protein": warehouse["dim_protein"].unionByName(
            spark.createDataFrame([protein(b, None, None, 1, "x") for _, b, _ in hub], PROTEIN)
        ),
        "fact_interaction": spark.createDataFrame(hub, "uniprot_a string, uniprot_b string, combined_score int"),
    }
    partners = card(spark, tables, "P01308")[cards.PARTNERS]
    assert [p["accession"] for p in partners] == [f"X{i:02d}" for i in range(20)]


def test_kpis_and_spokes_respect_the_threshold(spark, warehouse):
    all_cards = cards.story_cards(warehouse)
    assert rows(cards.card_kpis(all_cards, 0.95)) == [("P01308", 2, 0, 0), ("P06213", 3, 0, 2), ("P08069", 1, 0, 0)]
    spokes = cards.ego_edges(all_cards, 0.6).where(F.col(ANCHOR) == "P06213")
    assert rows(spokes, "entity_type", "id", "label", "detail", "strength") == [
        ("drug", "C1", "Insulin glargine", "Approved", 1.0),
        ("drug", "C2", "C2", "Late-stage trials", 0.75),
        ("partner", "P01308", "INS", "confidence 100%", 0.999),
    ]


def test_search_ranks_prefixes_then_short_names(spark, warehouse):
    keys = lambda q, **kw: [r[0] for r in lookup.search(warehouse["dim_protein"], q, **kw).collect()]
    assert keys("insulin") == ["P01308", "P06213", "P08069"]
    assert keys("p06213") == ["P06213"]
    assert keys("r", limit=2) == ["P06213", "P08069"]
    assert keys("nothing") == []


def test_map_counts(warehouse):
    got = {r[ANCHOR]: (r["disease_count"], r["drug_count"]) for r in lookup.map_extract(warehouse).collect()}
    assert got == {"P01308": (1, 0), "P06213": (1, 2), "P08069": (0, 0)}


def test_listing_lengths_and_neighbors(spark, warehouse):
    dim = warehouse["dim_protein"]
    assert lookup.list_proteins(dim).count() == 3
    keys = spark.createDataFrame([("P01308",), ("P06213",)], "k string")
    assert rows(lookup.lengths(dim, keys)) == [("P01308", 110), ("P06213", 1382)]
    assert lookup.lengths(dim, keys.limit(0)).count() == 0
    found = lookup.neighbors_of(warehouse["fact_protein_neighbor"], dim, keys)
    assert [(r["accession"], r["similarity"]) for r in found.orderBy("rank").collect()] == [
        ("P06213", 0.96), ("P08069", 0.91),
    ]
    first = lookup.neighbors_of(warehouse["fact_protein_neighbor"], dim, k=1)
    assert rows(first, "accession") == [("P06213",)]
    unknown = spark.createDataFrame([("X",)], "k string")
    assert lookup.neighbors_of(warehouse["fact_protein_neighbor"], dim, unknown).count() == 0


def test_composition_is_sorted_richest_first(spark):
    composed = spark.createDataFrame(
        [("P1", code, i, 10.0 - 0.5 * i) for i, (code, *_) in enumerate(K.AMINO_ACIDS)],
        "uniprot_accession string, amino_acid_code string, count long, pct_of_sequence double",
    ).repartition(3)
    found = lookup.composition(composed, amino_acids(spark)).collect()
    assert [r["amino_acid_code"] for r in found] == list(K.RESIDUES)
    assert found[0]["name"] == "Alanine" and found[0]["produced_by_body"] is True
    assert found[-1]["three_letter_code"] == "Val" and found[-1]["produced_by_body"] is False


def test_box_around_a_point(spark):
    points = spark.createDataFrame(
        [("a", 0.0, 0.0), ("b", 2.9, 2.9), ("c", 3.1, 0.0), ("d", 100.0, 100.0)], "k string, x double, y double"
    )
    assert rows(lookup.box_around(points, "k", "a", "x", "y"), "k") == [("a",), ("b",)]
    assert lookup.box_around(points, "k", "absent", "x", "y").count() == 0


def test_groups_fold(spark, warehouse):
    folded = lookup.fold_groups(lookup.map_extract(warehouse), ["Enzymes"])
    assert rows(folded, "family_group") == [("Enzymes",), ("Enzymes",), ("Unclassified",)]
