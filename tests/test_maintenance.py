"""Storage, patches, rewrites and embeddings."""

from __future__ import annotations

import hashlib
import json
import os
import sys

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F

from keystar.operators.embedding import embed, masked_mean, project_2d
from keystar.operators.patch import apply_patch, check_patch, member_check, patch_by_key, split_members
from keystar.plans import rewrite as R
from keystar.plans.vectors import fact_embedding, fact_protein_neighbor
from keystar.session import scratch_path, scratch_root, scratch_run, stash
from keystar.sources import storage
from tests.conftest import rows

register_pickle_by_value(sys.modules[__name__])


def test_scratch_is_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert stash(spark.range(3), "ids").count() == 3


def test_run_folder_goes_with_its_run(spark):
    with scratch_run(spark) as folder:
        inside = stash(spark.range(3), "ids")
        assert inside.inputFiles()[0].startswith(f"file://{folder}/ids-") and inside.count() == 3
    assert not os.path.exists(folder)
    assert not scratch_path(spark, "x").startswith(folder)


def test_versioned_write_is_skipped_unless_forced(spark, tmp_path):
    path = storage.versioned_path(str(tmp_path), "group", "1", "relation")
    assert path.endswith("/group/v1/relation")
    assert not storage.exists(spark, path)
    assert storage.materialize(spark, path, lambda: spark.range(3)) == (3, True)
    assert storage.materialize(spark, path, lambda: spark.range(5)) == (3, False)
    assert storage.materialize(spark, path, lambda: spark.range(5), force=True) == (5, True)
    (tmp_path / "half").mkdir()
    assert not storage.exists(spark, str(tmp_path / "half"))
    storage.write_manifest(spark, f"{path}.manifest", batch="b1")
    assert storage.read_manifest(spark, f"{path}.manifest").first()["batch"] == "b1"
    storage.register_views(spark, {"relation": path}, prefix="v_")
    assert spark.sql("SELECT count(*) FROM v_relation").first()[0] == 5


def test_patch_keeps_the_count(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    patch = spark.createDataFrame([("b", 20)], "k string, v int")
    merged = patch_by_key(old, patch, "k")
    check_patch(old, merged)
    assert rows(merged) == [("a", 1), ("b", 20), ("c", 3)]
    stray = spark.createDataFrame([("z", 0)], "k string, v int")
    with pytest.raises(ValueError, match="row count changed"):
        check_patch(old, patch_by_key(old, stray, "k"))


def test_members(spark):
    result = spark.createDataFrame([("a",), ("a",), ("x",)], "k string")
    expected = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(member_check(result, expected, "k")) == [("a", True), ("b", False)]
    found, missing = split_members(result, expected, "k")
    assert (rows(found), rows(missing)) == ([("a",)], [("b",)])


SOURCE = [("P1", "A", "one", "text one"), ("P2", "B", "two", None), ("P3", None, None, "No information available"),
          ("P4", "D", "four", "text four")]
SOURCE_SCHEMA = "uniprot_accession string, gene_symbol string, protein_name string, function_raw string"


def answer(prompts):
    assert all("none available" not in p for p in prompts)
    return [json.dumps({"function_friendly": p.split("\n")[-1].upper(), "tagline": 7}) for p in prompts]


def test_rewrites_keep_every_key_and_skip_missing_text(spark, tmp_path):
    source = spark.createDataFrame(SOURCE, SOURCE_SCHEMA).repartition(3)
    done = R.rewrite(source, answer, "m", path=str(tmp_path / "responses"))
    assert rows(spark.read.parquet(str(tmp_path / "responses")), "uniprot_accession") == [("P1",), ("P4",)]
    assert rows(done, "uniprot_accession", "function_friendly", "tagline", "model_id") == [
        ("P1", "TEXT ONE", None, "m"), ("P2", None, None, "m"), ("P3", None, None, "m"), ("P4", "TEXT FOUR", None, "m"),
    ]
    assert rows(R.rewrite_metrics(done)) == [(4, 2, 0)]
    trial = R.rewrite(source, answer, "m", limit=2)
    assert rows(trial, "uniprot_accession") == [("P1",), ("P2",)]


def test_calls_are_chunked(spark):
    prompts = spark.createDataFrame([(f"P{i}", "x") for i in range(7)], "uniprot_accession string, prompt string").coalesce(1)
    sized = R.call_batches(prompts, lambda batch: [str(len(batch))] * len(batch), batch=3)
    assert sorted(r["response"] for r in sized.collect()) == ["1", "3", "3", "3", "3", "3", "3"]


def test_only_quote_broken_rows_are_redone(spark):
    source = spark.createDataFrame(SOURCE, SOURCE_SCHEMA)
    rewrites = spark.createDataFrame(
        [("P1", None, None), ("P2", None, None), ("P3", None, None), ("P4", "fine", None)],
        "uniprot_accession string, function_friendly string, tagline string",
    )
    broken = '{"function_friendly": "the "open" state"}'
    responses = spark.createDataFrame(
        [("P1", broken), ("P2", broken), ("P3", broken), ("P4", broken)], "uniprot_accession string, response string"
    )
    assert rows(R.rows_to_redo(rewrites, responses, source), "uniprot_accession") == [("P1",)]
    declined = responses.withColumn("response", F.lit('{"function_friendly": null}'))
    assert R.rows_to_redo(rewrites, declined, source).count() == 0


def test_masked_mean_leaves_padding_out():
    hidden = np.array([[[2.0, 4.0], [4.0, 8.0], [99.0, 99.0]]])
    assert masked_mean(hidden, np.array([[True, True, False]])).tolist() == [[3.0, 6.0]]
    assert masked_mean(hidden, np.zeros((1, 3), bool)).tolist() == [[0.0, 0.0]]


def letters_model():
    def predict(texts):
        return np.array([[len(t), t.count("A") + 1] for t in texts], dtype=np.float32)

    return predict


def test_embedding_relation(spark):
    dim = spark.createDataFrame(
        [("P1", "A" * 1022), ("P2", "A" * 1023), ("P3", "MKV"), ("P4", None), ("P5", "AAK")],
        "uniprot_accession string, sequence string",
    )
    embedded = embed(dim, "sequence", letters_model, batch=2)
    got = {r[0]: (r["embedding"], r["was_truncated"]) for r in embedded.collect()}
    assert got == {
        "P1": ([1022.0, 1023.0], False), "P2": ([1022.0, 1023.0], True), "P3": ([3.0, 1.0], False), "P5": ([3.0, 3.0], False),
    }
    fact = fact_embedding(dim, letters_model, "letters")
    assert fact.columns == [
        "uniprot_accession", "embedding", "umap_x", "umap_y", "model_version", "was_truncated", "computed_at",
    ]
    assert [t for _, t in fact.dtypes][1:4] == ["array<float>", "float", "float"]
    assert fact.count() == 4
    near = fact_protein_neighbor(embedded, 2)
    assert near.dtypes == [
        ("uniprot_accession", "string"), ("neighbor_accession", "string"), ("similarity", "float"), ("rank", "int"),
    ]
    assert near.count() == 8


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "relation")
    storage.write_parquet(spark.range(3), path)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    for attempt in (
        lambda: storage.write_parquet(broken, path),
        lambda: storage.materialize(spark, path, lambda: broken, force=True),
    ):
        with pytest.raises(Exception, match="no"):
            attempt()
        assert storage.count_rows(spark, path) == 3
    storage.write_parquet(storage.read_parquet(spark, path).where("id > 0"), path)
    assert storage.count_rows(spark, path) == 2
    assert [p.name for p in tmp_path.iterdir()] == ["relation"]


def test_failed_load_leaves_the_old_table(spark, tmp_path):
    name = scratch_path(spark, "t").rsplit("/", 1)[1].replace("-", "_")
    storage.replace_table(spark.range(3), name, str(tmp_path))
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        storage.replace_table(broken, name, str(tmp_path))
    assert spark.table(name).count() == 3
    storage.replace_table(spark.table(name).where("id > 0"), name, str(tmp_path))
    assert spark.table(name).count() == 2


def _scanned(frame):
    """Rows of the result, and rows that the scan handed on."""
    found = frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return found, leaves.head().metrics().apply("numOutputRows").value()


def test_point_reads_skip_row_groups(spark, tmp_path):
    n = 40_000
    data = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"),
        F.sha2(F.concat(F.lit("s"), F.col("id")), 256).alias("symbol"),
        F.col("id").alias("v"),
    )
    small = {"parquet.block.size": "200000"}
    read = {}
    for kind, looked_up in (("plain", []), ("bloom", ["k", "symbol"])):
        name = scratch_path(spark, kind).rsplit("/", 1)[1].replace("-", "_")
        folder = tmp_path / kind
        storage.replace_table(data, name, str(folder), "k", 2, looked_up, small)
        groups = [
            pq.ParquetFile(f).metadata.row_group(i).num_rows
            for f in sorted(folder.rglob("*.parquet"))
            for i in range(pq.ParquetFile(f).num_row_groups)
        ]
        assert sum(groups) == n and len(groups) > 10
        stored = spark.table(name)
        # The key is sorted inside its bucket: its range alone leaves one row group.
        found, scanned = _scanned(stored.where(F.col("k") == F.sha2(F.lit("77").cast("binary"), 256)))
        assert [r.v for r in found] == [77] and scanned <= max(groups)
        symbol = hashlib.sha256(b"s77").hexdigest()
        found, read[kind] = _scanned(stored.where(F.col("symbol") == symbol))
        assert [r.v for r in found] == [77]
        absent = hashlib.sha256(b"nowhere").hexdigest()
        found, read[kind, "absent"] = _scanned(stored.where(F.col("symbol") == absent))
        assert found == []
    # Symbols lie anywhere, so every row group's range holds them; filters tell the one.
    assert read["plain"] > n / 2 and read["bloom"] <= 2 * max(groups)
    assert read["plain", "absent"] > n / 2 and read["bloom", "absent"] <= max(groups)


def test_patch_in_place_is_checked_before_the_swap(spark, tmp_path):
    path = str(tmp_path / "relation")
    storage.write_parquet(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path)
    patch = spark.createDataFrame([("b", 20)], "k string, v int")
    assert apply_patch(spark, path, patch, "k") == 2
    stray = spark.createDataFrame([("z", 0)], "k string, v int")
    with pytest.raises(ValueError, match="row count changed"):
        apply_patch(spark, path, stray, "k")
    assert rows(storage.read_parquet(spark, path)) == [("a", 1), ("b", 20)]


def test_answers_are_not_paid_twice(spark, tmp_path):
    source = spark.createDataFrame(
        [(f"P{i}", f"G{i}", "n", "text" if i else None) for i in range(6)],
        "uniprot_accession string, gene_symbol string, protein_name string, function_raw string",
    )
    path = str(tmp_path / "answers")

    def answer(prompts):
        return ['{"function_friendly": "f", "tagline": "t"}' for _ in prompts]

    assert R.send(R.requests(source, 3), answer, path, "m") == 2
    assert storage.read_manifest(spark, f"{path}.manifest").first()["model_id"] == "m"
    assert R.send(R.requests(source), answer, path, "m", partitions=2, waves=2) == 3
    assert R.send(R.requests(source), answer, path, "m") == 0
    assert R.send(R.requests(source), answer, path, "m", force=True) == 5

    def fail(prompts):
        raise RuntimeError("called again")

    got = R.rewrite(source, fail, "m", path=path)
    assert got.where("function_friendly = 'f'").count() == 5 and got.count() == 6


def test_rows_without_a_direction_keep_their_place(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None)], "id int, v array<double>"
    )
    got = {r["id"]: r for r in project_2d(df, "v").collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[3]["umap_x"] is got[4]["umap_y"] is None and got[1]["umap_x"] is not None


def test_projection_is_the_principal_plane(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 5)) * np.array([3.0, 2.0, 0.5, 0.1, 0.1]) + 5.0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, v array<double>")
    got = np.array([[r["umap_x"], r["umap_y"]] for r in project_2d(df, "v").orderBy("id").collect()])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    _, _, axes = np.linalg.svd(unit - unit.mean(axis=0), full_matrices=False)
    for axis, found in zip(axes[:2], got.T):
        axis = axis if axis[np.abs(axis).argmax()] > 0 else -axis
        assert np.allclose(unit @ axis, found, atol=1e-4)
