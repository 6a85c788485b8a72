"""The kept embeddings: what is sent to the model, and what comes out."""

from __future__ import annotations

import uuid

import numpy as np
import pytest

from keystar.plans.embedding_state import (
    STATE,
    as_embedding,
    classify_sequences,
    refresh_embeddings,
    unseen_texts,
)
from keystar.plans.vectors import assemble_embedding
from keystar.session import stash
from tests.conftest import rows

DIM = "uniprot_accession string, sequence string"


def counting_model(folder):
    """A model that leaves a file per text it sees, executors and driver sharing the folder."""

    def factory():
        def predict(texts: np.ndarray) -> np.ndarray:
            for text in texts:
                (folder / f"{len(text)}-{uuid.uuid4().hex}").write_text(text)
            return np.array([[len(t), sum(map(ord, t)) % 1000] for t in texts], dtype=np.float32)

        return predict

    return factory


def seen(folder):
    found = sorted(p.read_text() for p in folder.iterdir())
    for path in folder.iterdir():
        path.unlink()
    return found


def test_second_run_sends_the_difference(spark, tmp_path):
    first = spark.createDataFrame(
        [("A", "AAAA"), ("B", "BB"), ("C", "CCC"), ("D", "BB"), ("E", None), (None, "X"), ("G", "GGGGG")], DIM
    )
    nothing = spark.createDataFrame([], STATE)
    state = stash(refresh_embeddings(first, nothing, counting_model(tmp_path), "v1"), "state")
    assert seen(tmp_path) == ["AAAA", "BB", "CCC", "GGGGG"]
    assert rows(state, "uniprot_accession", "embedding") == sorted(
        [("A", [4.0, 260.0]), ("B", [2.0, 132.0]), ("C", [3.0, 201.0]), ("D", [2.0, 132.0]), ("G", [5.0, 355.0])]
    )
    # B changed to a text that is known, D to a new one, C is gone, E and F are new with one text.
    second = spark.createDataFrame(
        [("A", "AAAA"), ("B", "CCC"), ("D", "DD"), ("E", "EEE"), ("F", "EEE"), ("G", None)], DIM
    )
    status = {a: s for a, _, s in rows(classify_sequences(second, state, "v1"))}
    assert status == {
        "A": "same", "B": "changed", "C": "gone", "D": "changed", "E": "new", "F": "new", "G": "gone",
    }
    after = stash(refresh_embeddings(second, state, counting_model(tmp_path), "v1"), "state")
    assert seen(tmp_path) == ["DD", "EEE"]
    whole = refresh_embeddings(second, nothing, counting_model(tmp_path), "v1")
    assert rows(after) == rows(whole)
    seen(tmp_path)
    # Nothing changed: nothing is sent. Another version: everything is.
    assert rows(refresh_embeddings(second, after, counting_model(tmp_path), "v1")) == rows(after)
    assert seen(tmp_path) == []
    assert unseen_texts(second, after, "v2").count() == 4
    assert {s for *_, s in rows(classify_sequences(second, after, "v2"))} == {"changed"}


@pytest.mark.parametrize("data", [[], [("A", None)]])
def test_nothing_to_embed(spark, tmp_path, data):
    dim = spark.createDataFrame(data, DIM)
    state = refresh_embeddings(dim, spark.createDataFrame([], STATE), counting_model(tmp_path), "v1")
    assert rows(state) == [] and seen(tmp_path) == []


def test_fact_from_the_state(spark, tmp_path):
    dim = spark.createDataFrame([("A", "AAAA"), ("B", "BB"), ("C", "CCCCCCC")], DIM)
    state = refresh_embeddings(dim, spark.createDataFrame([], STATE), counting_model(tmp_path), "v1")
    fact = assemble_embedding(stash(as_embedding(state), "state"), "v1")
    assert fact.where("umap_x IS NOT NULL").count() == 3
