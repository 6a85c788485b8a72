"""Indexed search against the scan, and how much of the index it reads."""

from __future__ import annotations

import random

import pytest

from keystar.plans.lookup import search
from keystar.plans.text_index import read_postings, search_indexed, trigrams_of, write_text_index
from tests.conftest import rows

BUCKETS = 64


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(1)
    words = ["insulin", "Receptor", "kinase", "ÄTHER", "100% pure_x", "beta", "ab", "İstanbul"]
    data = [
        (f"P{i:04}", rng.choice([None, "INS", f"G{i}", "a"]), " ".join(rng.sample(words, rng.randrange(3))))
        for i in range(400)
    ] + [("P9999", "aaaa", None), ("P9998", None, "xaaax")]
    dim = spark.createDataFrame(data, "uniprot_accession string, gene_symbol string, protein_name string")
    path = str(tmp_path_factory.mktemp("index") / "postings")
    write_text_index(dim, path, BUCKETS)
    return dim, path


@pytest.mark.parametrize(
    "query",
    ["insul", "INS", "kin%rec", "rec%kin", "p00", "aaa", "aaaa", "ab", "", "%", "_ns", "äth", "ÄTH",
     "100%", "pure_x", "nothing here", "i%s%u", "g1_", "İst", "beta ab"],
)
def test_same_rows_as_the_scan(spark, indexed, query):
    dim, path = indexed
    got = search_indexed(dim, path, query, BUCKETS, limit=1000)
    assert rows(got) == rows(search(dim, query, 1000))


def test_few_rows_are_read(spark, indexed):
    _, path = indexed
    everything = spark.read.parquet(path).count()
    read = read_postings(spark, path, trigrams_of("insulin"), BUCKETS)
    assert 0 < read.count() < everything / 3
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan


def test_trigrams():
    assert trigrams_of("InsuLin%ab_kin") == ["ins", "kin", "lin", "nsu", "sul", "uli"]
    assert trigrams_of("ab%cd_") == trigrams_of("äther") == trigrams_of("") == []
