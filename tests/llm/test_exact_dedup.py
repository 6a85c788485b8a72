"""Exact dedup against grouping by text, and its filters."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keystar.llm import exact_dedup
from keystar.llm.fuse import FuseFilter
from keystar.llm.queries import QUERIES, SQL
from tests.conftest import rows
from tools.compare import connect


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 5_000, 120_000])
def test_filter_knows_its_keys(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
    keys = np.unique(keys)
    made = FuseFilter.build(keys)
    assert made.maybe(keys).all()
    others = np.random.default_rng(n + 1).integers(2**63, 2**64, 20_000, dtype=np.uint64)
    assert made.maybe(others).mean() < 0.02 if n else True
    if n > 1000:
        assert len(made.slots) < 1.4 * n


def plain(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(t or "", []).append(i)
    found = []
    for i, t in docs:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        digest = hashlib.sha256((t or "").encode()).hexdigest()
        found.append((i, keep, len(ids), i == keep, digest))
    return sorted(found, key=repr)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("old", ["doc_id % 2 = 0", "true", "false", "doc_id < 6"])
def test_odd_rows(spark, old, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_ROWS", 2)
    docs = [
        (1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, " "), (7, "x" * 100_000),
        (8, "x" * 100_000), (9, "x" * 99_999), (10, "a"), (10, "a"), (None, "a"), (None, "z"),
        (None, "z"), (11, "é"), (12, "é"), (13, "alone"),
    ]
    frame = spark.createDataFrame(
        [(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n int, digest string"
    )
    got = exact_dedup.dedup(frame, F.expr(old))
    assert rows(got, *COLUMNS) == plain(docs)
    assert rows(exact_dedup.dedup(frame.limit(0), F.expr(old))) == []


def test_equal_digests_of_different_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_digest", lambda c: F.unhex(F.md5(F.substring(c, 1, 1))))
    docs = [(1, "ab"), (2, "ac"), (3, "ab"), (4, "b"), (5, "ac"), (6, "ad")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = exact_dedup.dedup(frame, F.col("doc_id") < 3)
    want = [(i, k, n, kept) for i, k, n, kept, _ in plain(docs)]
    assert rows(got, *COLUMNS[:4]) == want


def test_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op3_exact_dedup"](spark, sf)
    assert rows(got, *COLUMNS) == sorted(
        connect(sf)
        .execute(f"SELECT {', '.join(COLUMNS)} FROM ({SQL['op3_exact_dedup']})")
        .fetchall(),
        key=repr,
    )
