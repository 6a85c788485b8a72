"""The pipeline's stages against brute force on a whole small table and on odd rows."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from keystar.llm.queries import QUERIES
from tests.llm.test_packing import verify
from tests.llm.test_simhash import plain_components, plain_simhash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "packing"]

    scores = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, SF).collect()}
    clean = {i: r.text for i, r in rows.items() if not scores[i].predicted}
    unique = {}
    for i in sorted(clean):
        unique[hashlib.sha256(clean[i].encode()).digest()] = i
    distinct = {i: clean[i] for i in unique.values()}
    label = plain_components({i: plain_simhash(t) for i, t in distinct.items()})
    final = {i: distinct[i] for i in set(label.values())}

    kept = docs
    for (_, stage), want in zip(
        corpus_pipeline.STAGES[:3], (clean, distinct, final), strict=True
    ):
        kept = spark.createDataFrame(stage(spark, kept, SF).collect(), docs.schema)
        assert kept.columns == COLUMNS
        found = {r.doc_id: r for r in kept.collect()}
        assert set(found) == set(want)
        assert all(found[i] == rows[i] for i in found)
    got = corpus_pipeline.run(spark, SF).collect()
    used, bound = verify(final.items(), got, 2048)
    assert used <= bound + 2


@pytest.mark.parametrize("stage", ["exact_dedup", "near_dedup"])
def test_odd_rows(spark, stage):
    text = " ".join(f"word{i}" for i in range(50))
    data = [
        (1, text, "en", "a", 5), (2, text, None, "a", 5), (2, text, None, "a", 5),
        (None, text, "en", None, 5), (3, None, "en", "a", None), (4, "", "en", "a", 0),
        (None, "nobody has an id for this text at all", "en", "a", 1),
        (None, "nobody has an id for this text at all", "en", "b", 1),
        (5, "another text of one row that is unlike the others", "en", "a", 1),
        (5, "another text of one row that is unlike the others", "en", "a", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(data, schema)
    run = dict(corpus_pipeline.STAGES)[stage]
    got = run(spark, frame, SF)
    assert got.columns == COLUMNS
    texts = sorted((r.text or "") for r in got.collect())
    assert texts == sorted({t or "" for _, t, *_ in data})
    assert run(spark, frame.limit(0), SF).collect() == []


def test_clashing_columns_are_kept(spark):
    texts = [" ".join(f"{w}{i}" for i in range(50)) for w in ("alpha", "beta")]
    data = [(1, texts[0], "n1", "d1"), (2, texts[0], "n2", "d2"), (3, texts[1], "n3", "d3")]
    frame = spark.createDataFrame(data, "doc_id long, text string, _name string, _digest string")
    got = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, frame, SF)
    assert got.columns == frame.columns
    assert sorted(map(tuple, got.collect())) == data[1:]


def test_near_dedup_of_ids_on_several_texts(spark):
    texts = [" ".join(f"{w}{i}" for i in range(50)) for w in ("alpha", "beta", "gamma", "delta")]
    one, two, three, four = texts
    data = [(1, one), (1, two), (2, two), (3, three), (3, four), (4, four), (5, one), (1, three)]
    frame = spark.createDataFrame(
        [(i, t, "en", "a", len(t)) for i, t in data],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    got = sorted((r.doc_id, r.text) for r in stage(spark, frame, SF).collect())
    assert got == sorted([(1, one), (1, two), (1, three), (3, four)])
