from __future__ import annotations

import gzip
import json

import pytest
from pyspark.errors import AnalysisException

from keystar import schemas
from keystar.operators.dedup import keep_first
from keystar.operators.quality import schema_differences
from keystar.operators.resolve import resolve_edges, resolve_ids
from keystar.sources import readers
from tests.conftest import rows

FULL = {
    "primaryAccession": "P01308",
    "secondaryAccessions": ["Q5EEX2"],
    "genes": [{"geneName": {"value": "INS"}}, {"geneName": {"value": "OTHER"}}],
    "proteinDescription": {
        "recommendedName": {"fullName": {"value": "Insulin"}},
        "submissionNames": [{"fullName": {"value": "unused"}}],
    },
    "sequence": {"value": "MALW", "length": 4},
    "comments": [
        {"commentType": "SUBUNIT", "texts": [{"value": "no"}]},
        {"commentType": "FUNCTION", "texts": [{"value": "Lowers blood glucose."}, {"value": "more"}]},
        {"commentType": "FUNCTION", "texts": [{"value": "second"}]},
    ],
    "keywords": [{"name": "Hormone"}, {"id": "KW-1"}, {"name": ""}, {"name": "Hormone"}],
    "uniProtKBCrossReferences": [
        {"database": "Pfam", "id": "PF00049"},
        {"database": "Pfam", "id": "PF00049"},
        {"database": "STRING", "id": "9606.ENSP1"},
        {
            "database": "Ensembl",
            "id": "ENST1",
            "properties": [
                {"key": "ProteinId", "value": "ENSP1"},
                {"key": "GeneId", "value": "ENSG2"},
                {"key": "GeneId", "value": "ENSG1"},
            ],
        },
        {"database": "Ensembl", "id": "ENST2", "properties": [{"key": "GeneId", "value": "ENSG2"}]},
        {"database": "Ensembl", "id": "ENST3"},
    ],
    "ignored": 1,
}
BARE = {"primaryAccession": "X00001", "sequence": {"value": "MK", "length": 2}}
SUBMITTED = {
    "primaryAccession": "X00002",
    "proteinDescription": {"submissionNames": [{"fullName": {"value": "Sub"}}]},
    "comments": [
        {"commentType": "FUNCTION", "texts": []},
        {"commentType": "FUNCTION", "texts": [{"value": "too late"}]},
    ],
}


def test_entries_are_flattened(spark, tmp_path):
    path = tmp_path / "entries.jsonl"
    path.write_text("\n".join(json.dumps(e) for e in (FULL, BARE, SUBMITTED)))
    df = readers.read_entries(spark, str(path))
    assert schema_differences(df, schemas.UNIPROT) == []
    got = {r["primary_accession"]: r.asDict() for r in df.collect()}
    full = got["P01308"]
    assert full["secondary_accessions"] == ["Q5EEX2"]
    assert (full["gene_symbol"], full["protein_name"]) == ("INS", "Insulin")
    assert (full["sequence"], full["sequence_length"]) == ("MALW", 4)
    assert full["function_raw"] == "Lowers blood glucose."
    assert full["keywords"] == ["Hormone", "Hormone"]
    assert full["pfam_ids"] == ["PF00049"]
    assert full["ensembl_gene_ids"] == ["ENSG2", "ENSG1"]
    assert full["string_ids"] == ["9606.ENSP1"]
    bare = got["X00001"]
    assert bare["gene_symbol"] is bare["protein_name"] is bare["function_raw"] is None
    for name in ("secondary_accessions", "keywords", "pfam_ids", "ensembl_gene_ids", "string_ids"):
        assert bare[name] == []
    # The first function comment counts even when it is empty.
    assert got["X00002"]["protein_name"] == "Sub"
    assert got["X00002"]["function_raw"] is None


def test_pages_and_missing_key(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "1.json").write_text(json.dumps({"results": [FULL, BARE]}, indent=1))
    (pages / "2.json").write_text(json.dumps({"results": [SUBMITTED]}, indent=1))
    df = readers.read_entries(spark, str(pages), paged=True)
    assert rows(df, "primary_accession") == [("P01308",), ("X00001",), ("X00002",)]
    (pages / "3.json").write_text(json.dumps({"results": [{"sequence": {"value": "M"}}]}))
    with pytest.raises(Exception, match="primaryAccession"):
        readers.read_entries(spark, str(pages), paged=True).collect()


def test_alias_and_edge_files(spark, tmp_path):
    aliases = tmp_path / "aliases.txt.gz"
    with gzip.open(aliases, "wt") as f:
        f.write("#string_protein_id\talias\tsource\n")
        f.write("9606.E1\tP01308\tEnsembl_UniProt\textra\n9606.E1\tshort\n")
        f.write("9606.E2\tP06213\tUniProt_AC\n9606.E3\tINS\tHGNC\n")
    mapping = resolve_ids(readers.read_aliases(spark, str(aliases)))
    assert rows(mapping) == [("9606.E1", "P01308"), ("9606.E2", "P06213")]

    links = tmp_path / "links.txt.gz"
    with gzip.open(links, "wt") as f:
        f.write("protein1 protein2 combined_score\n")
        f.write("9606.E1 9606.E2 800\n9606.E1   9606.E2\t600\n9606.E1 9606.E9 900\nbroken line\n")
        f.write("9606.E2 9606.E1 700\n")
    edges, seen = resolve_edges(readers.read_edges(spark, str(links), 700, partitions=3), mapping)
    assert rows(edges) == [("P01308", "P06213", 800), ("P06213", "P01308", 700)]
    assert seen.get == {"kept": 2, "unmapped": 1}
    assert schema_differences(edges, schemas.STRING_EDGES) == []
    none, _ = resolve_edges(readers.read_edges(spark, str(links), 1001), mapping)
    assert none.count() == 0 and none.columns == schemas.STRING_EDGES.names


def test_tsv_columns_nulls_and_first_row(spark, tmp_path):
    header = "Extra\tGene\tUniprot\tProtein class\tRNA tissue specificity\tRNA tissue distribution\tSubcellular location\tDisease involvement"
    path = tmp_path / "annotations.tsv"
    path.write_text(
        "\n".join(
            [
                header,
                "x\tINS\tP01308\tSecreted\tNA\t\tGolgi\tDiabetes",
                "x\tINS2\tP01308\tother\tlater\tlater\tlater\tlater",
                "x\tN1\t\tfirst null\t\t\t\t",
                "x\tN2\tNA\tsecond null\t\t\t\t",
            ]
        )
    )
    scanned = readers.read_tsv(spark, str(path), schemas.HPA_COLUMNS)
    kept = keep_first(scanned, ["uniprot_accession"], readers.ORD).drop(readers.ORD)
    assert schema_differences(kept, schemas.HPA) == []
    got = {r["uniprot_accession"]: r for r in kept.collect()}
    assert set(got) == {"P01308", None}
    assert got["P01308"]["gene_symbol"] == "INS"
    assert got["P01308"]["rna_tissue_specificity"] is None
    assert got["P01308"]["rna_tissue_distribution"] is None
    assert got[None]["protein_class"] == "first null"
    with pytest.raises(AnalysisException):
        readers.read_tsv(spark, str(path), {"Absent": "a"})


def test_parts_fail_loudly(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(10).selectExpr("id", "id * 2 AS extra").repartition(2).write.parquet(path)
    assert readers.read_parts(spark, path, ["id"]).columns == ["id"]
    assert readers.read_parts(spark, path, ["id"]).count() == 10
    with pytest.raises(ValueError, match="no column absent"):
        readers.read_parts(spark, path, ["absent"])
    spark.range(3).selectExpr("id", "id AS other").write.mode("append").parquet(path)
    assert readers.read_parts(spark, path, ["id"]).count() == 13
    with pytest.raises(ValueError, match="no column extra"):
        readers.read_parts(spark, path, ["id", "extra"])
    with pytest.raises(AnalysisException):
        readers.read_parts(spark, str(tmp_path / "nowhere"), ["id"])


def test_seed_types_quotes_and_trailing_null(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(
        "amino_acid_code,name,three_letter_code,category,produced_by_body,description,deficiency_note\n"
        'A,Alanine,Ala,Nonpolar aliphatic,true,"Small; common, flexible.",\n'
        'H,Histidine,His,Positively charged,false,"Says ""pH"".",Needed in the diet\n'
    )
    df = readers.read_seed(spark, str(path), schemas.SEED_AMINO_ACIDS)
    assert schema_differences(df, schemas.SEED_AMINO_ACIDS) == []
    a, h = df.orderBy("amino_acid_code").collect()
    assert a["produced_by_body"] is True and a["deficiency_note"] is None
    assert a["description"] == "Small; common, flexible."
    assert h["description"] == 'Says "pH".'


def test_pipe_table(spark, tmp_path):
    path = tmp_path / "list.md"
    path.write_text(
        "# Title\n| Gene | Tagline | Text |\n|---|:--|---|\n|---|---|---|\n"
        "  | INS |  the tag | the text |  \n| a | b |\n| | empty | x |\n| INSR | t | f | more |\nplain | text | here\n"
    )
    df = readers.read_pipe_table(spark, str(path))
    assert rows(df, "symbol", "tagline", "text") == [
        ("INS", "the tag", "the text"),
        ("INSR", "t", "f"),
    ]


def test_spread_does_what_it_is_told(spark):
    assert readers.spread(spark.range(0, 10, 1, 1), 4).rdd.getNumPartitions() == 4
    assert readers.spread(spark.range(0, 100, 1, 9)).rdd.getNumPartitions() == 9


@pytest.mark.parametrize("line", ["no json", '{"sequence": {"value": "MK"}}'])
def test_broken_entries_stop_every_query(spark, tmp_path, line):
    path = tmp_path / "entries.jsonl"
    path.write_text("\n".join([json.dumps(FULL), line]))
    with pytest.raises(Exception, match="entry without primaryAccession"):
        readers.read_entries(spark, str(path)).count()


def test_files_with_another_header_are_an_error(spark, tmp_path):
    folder = tmp_path / "tsv"
    folder.mkdir()
    (folder / "a.tsv").write_text("Gene\tKey\ng1\tk1\n")
    (folder / "b.tsv").write_text("Key\tGene\nk2\tg2\n")
    with pytest.raises(Exception, match="header"):
        readers.read_tsv(spark, str(folder), {"Gene": "gene", "Key": "key"}).collect()


def test_two_resolved_edge_sets_in_one_plan(spark):
    mapping = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, accession string")
    edges = spark.createDataFrame([("a", "b", 900)], "protein1 string, protein2 string, combined_score int")
    one, two = (resolve_edges(edges, mapping)[0] for _ in range(2))
    assert one.unionByName(two).count() == 2
