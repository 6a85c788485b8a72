from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keystar.operators.resolve import count_edges, match_symbols, resolve_edges, resolve_ids
from tests.conftest import rows

H, E, A = "Ensembl_HGNC_uniprot_ids", "Ensembl_UniProt", "UniProt_AC"

CASES = {
    "hgnc_wins": ([("P1", E), ("P9", A), ("P1", H)], "P1"),
    "hgnc_corroborated": ([("Q1", H), ("P2", H), ("P2", E), ("P2", A)], "P2"),
    "first_hgnc": ([("Q2", H), ("Q1", H), ("P2", E), ("P2", A)], "Q2"),
    "single_intersection": ([("Q9", A), ("P3", E), ("P3", A), ("INS", E)], "P3"),
    "many_intersections": ([("B1", A), ("B1", E), ("A1", A), ("A1", E)], "B1"),
    "repeated_alias": ([("Z1", A), ("P4", E), ("P4", E), ("P4", A)], "Z1"),
    "accession_first": ([("Z1", E), ("Y2", A), ("Y1", A)], "Y2"),
    "ensembl_last": ([("P5", E), ("INS", E)], "P5"),
    "irrelevant": ([("INS", "HGNC"), ("X", "BLAST")], None),
}


@pytest.mark.parametrize("parts", [1, 7])
def test_tiers_on_any_partitioning(spark, parts):
    data, ord_ = [], 0
    for name, (aliases, _) in CASES.items():
        for alias, source in aliases:
            data.append((name, alias, source, ord_))
            ord_ += 1
    df = spark.createDataFrame(data, "string_protein_id string, alias string, source string, ord int")
    shuffled = df.orderBy(F.xxhash64("alias", "source")).repartition(parts)
    got = dict(rows(resolve_ids(shuffled)))
    assert got == {name: answer for name, (_, answer) in CASES.items() if answer}


def test_no_aliases(spark):
    df = spark.createDataFrame([], "string_protein_id string, alias string, source string, ord int")
    assert resolve_ids(df).count() == 0


def test_blank_mapping_counts_as_unmapped(spark):
    edges = spark.createDataFrame(
        [("a", "b", 900), ("a", "c", 900), ("a", "z", 900), ("a", "b", 10)],
        "protein1 string, protein2 string, combined_score int",
    )
    mapping = spark.createDataFrame([("a", "P1"), ("b", "P2"), ("c", "")], "id string, accession string")
    kept, seen = resolve_edges(edges, mapping, min_score=700)
    assert rows(kept) == [("P1", "P2", 900)]
    assert seen.get == {"kept": 1, "unmapped": 2}
    assert rows(count_edges(edges, mapping, min_score=700)) == [(1, 2)]


def test_symbols_take_the_lowest_key(spark):
    wanted = spark.createDataFrame([("INS",), ("GONE",)], "symbol string")
    dim = spark.createDataFrame(
        [("INS", "P2"), ("INS", "P1"), (None, "P3")], "gene_symbol string, uniprot_accession string"
    )
    matched, unmatched = match_symbols(wanted, dim)
    assert rows(matched) == [("INS", "P1")]
    assert rows(unmatched) == [("GONE",)]
