"""Landed files of every source to bronze, and the star from there."""

from __future__ import annotations

import gzip
import json

import pytest

from keystar import schemas
from keystar.plans import ingest
from keystar.plans.warehouse import build_star, load_bronze
from keystar.sources import storage
from tests.conftest import rows
from tests.test_readers import BARE, FULL

ALIASES = (
    "#string_protein_id\talias\tsource\n9606.A\tP01308\tUniProt_AC\n9606.B\tX00001\tUniProt_AC\n"
)
EDGES = "protein1 protein2 combined_score\n9606.A 9606.B 900\n9606.A 9606.C 800\n9606.B 9606.A 600\n"


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "entries.jsonl").write_text("\n".join(map(json.dumps, (FULL, BARE))))
    for name, text in (("aliases", ALIASES), ("edges", EDGES)):
        with gzip.open(tmp_path / f"{name}.gz", "wt") as out:
            out.write(text)
    header = "\t".join(schemas.HPA_COLUMNS)
    lines = ["INS\tP01308\tc\ts\td\tl\tx", "INS\tP01308\tsecond\ts\td\tl\tx", "Q\t\tc\ts\td\tl\tx"]
    (tmp_path / "annotations.tsv").write_text("\n".join([header, *lines]) + "\n")
    datasets = {}
    for name in ingest.DATASETS:
        datasets[name] = str(tmp_path / name)
        spark.createDataFrame([], schemas.BRONZE[name]).write.parquet(datasets[name])
    return ingest.Landed(
        str(tmp_path / "entries.jsonl"), str(tmp_path / "aliases.gz"), str(tmp_path / "edges.gz"),
        str(tmp_path / "annotations.tsv"), datasets,
    )


def test_all_sources(spark, landed, tmp_path):
    root = str(tmp_path / "bronze")
    done = ingest.ingest_all(spark, landed, root)
    assert set(done) == set(schemas.BRONZE) and all(x.written for x in done.values())
    assert {k: x.rows for k, x in done.items() if x.rows} == {"uniprot": 2, "string": 1, "hpa": 2}
    assert done["string"].unmapped == 1
    again = ingest.ingest_all(spark, landed, root)
    assert not any(x.written for x in again.values()) and again["string"].unmapped == 1
    assert ingest.ingest_all(spark, landed, root, force=True)["hpa"].written
    bronze = load_bronze(spark, root)
    assert rows(bronze["string"]) == [("P01308", "X00001", 900)]
    editorial = spark.createDataFrame([], schemas.SEED_EDITORIAL)
    star = build_star(spark, bronze, editorial)
    assert rows(star["fact_interaction"]) == [("P01308", "X00001", 900)]
    assert star["dim_protein"].count() == 2


def test_undeclared_types_are_not_written(spark, landed, tmp_path):
    path = str(tmp_path / "odd")
    spark.createDataFrame([(1, "x")], "id int, name string").write.parquet(path)
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="id: int instead of string"):
        ingest.ingest_dataset(spark, "ot_diseases", path, out)
    assert not storage.exists(spark, out)
