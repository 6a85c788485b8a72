"""Vector codes against plain integer k-means, and the bounds against full scans."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from keystar.llm import vector_codes as V
from keystar.llm.queries import QUERIES, SQL
from tests.conftest import rows

COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
HIGH = (1 << 63) - 1


def plain(data, entries):
    """Every step of the contract in Python integers."""

    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    def cell(x):
        return max(min(math.floor(1024 * float(np.float32(x))), HIGH), -HIGH - 1)

    kept = [(i, label, [cell(x) for x in v]) for i, v, label in data if usable(v)]
    width = -(-max((len(v) for _, _, v in kept), default=0) // 4)
    kept = [(i, label, v + [0] * (4 * width - len(v))) for i, label, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    parts = [[v[p * width : (p + 1) * width] for p in range(4)] for _, _, v in kept]
    books = [[list(x[p]) for x in parts[:entries]] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            own = [nearest(x[p], books[p])[1] for x in parts]
            for j in range(len(books[p])):
                members = [x[p] for x, o in zip(parts, own, strict=True) if o == j]
                if members:
                    books[p][j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    text = ",".join(str(c) for book in books for e in book for c in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    found, totals = [], {}
    for (i, label, _), x in zip(kept, parts, strict=True):
        best = [nearest(x[p], books[p]) for p in range(4)]
        error = min(sum(d for d, _ in best), HIGH)
        totals[label] = totals.get(label, 0) + error
        found.append((i, "".join(f"{j:02x}" for _, j in best), error, label))
    return sorted(((i, c, e, min(totals[x], HIGH), digest) for i, c, e, x in found), key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, state string, v int"


def frame(spark, data):
    return spark.createDataFrame([(i, v, x, "s", 1) for i, v, x in data], SCHEMA)


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(V, "ENTRIES", 5)
    same = [0.5, -0.25, 0.0, 1.0, 0.125]
    data = [
        (0, same, 1), (1, same, 1), (2, [0.1] * 5, None), (3, None, 1), (4, [None, 1.0], 1),
        (5, [float("nan")], 1), (6, [float("-inf")], 2), (7, [], 2), (8, [1.0], None),
        (9, [-0.3, 0.2, 0.7, 0.9, -1.1, 0.4], 3), (9, [-0.3, 0.2, 0.7], 3), (None, same, 3),
        (None, [0.2, 0.2], 3), (10, same, 1), (10, same, 1), (11, [0.09, 0.1, 0.1, 0.1, 0.1], None),
    ]
    assert rows(V.vector_codes(frame(spark, data)), *COLUMNS) == plain(data, 5)
    huge = [*data, (12, [1e9, -3e8], 3), (13, [3e38, 1.0, -3e38], 3)]
    assert rows(V.vector_codes(frame(spark, huge)), *COLUMNS) == plain(huge, 5)
    empty = [(1, [], 1), (2, [], None)]
    assert rows(V.vector_codes(frame(spark, empty)), *COLUMNS) == plain(empty, 5)
    assert rows(V.vector_codes(frame(spark, []))) == []


@pytest.mark.parametrize("n", [40, 300])
def test_many_vectors(spark, n):
    rng = np.random.default_rng(n)
    data = [
        (i * 3 % 1000, rng.normal(scale=0.03, size=8).round(2).tolist(), i % 3) for i in range(n)
    ]
    assert rows(V.vector_codes(frame(spark, data)), *COLUMNS) == plain(data, 256)


@pytest.mark.parametrize("scale", [40, 300, 10**9])
def test_bounds_leave_out_only_what_is_farther(scale):
    """Codebooks that move at random: same codes as a full scan, with fewer groups scanned."""
    rng = np.random.default_rng(scale % 97)
    x = (rng.normal(size=(400, 6)) * scale).astype(np.int64)
    x[:50] = x[50:100]
    history = [x[:100]]
    code, stamp = np.zeros(400, dtype=int), np.zeros((400, 4), dtype=np.uint8)
    bound = np.zeros((400, 4), dtype=np.uint16)
    scanned = []
    for _ in range(8):
        code, error, bound, stamp, n = V.assign(x, code, bound, stamp, history)
        full = V.distances(x, history[-1])
        assert code.tolist() == full.argmin(1).tolist()
        assert [int(e) for e in error] == [int(d) for d in full.min(1)]
        scanned.append(n)
        move = rng.normal(size=history[-1].shape) * scale * (0.02 if len(scanned) % 3 else 0.0)
        history.append(history[-1] + move.astype(np.int64))
    assert scanned[0] == 1600
    # A bound of more than HIGHEST is kept as HIGHEST, so large distances are scanned anew.
    assert scanned[-1] < 1400 or scale > V.HIGHEST


def test_net_way_is_shorter_than_the_summed_ways():
    a, b = np.zeros((3, 2), dtype=np.int64), np.full((3, 2), 50, dtype=np.int64)
    assert V.moved([a, b, a]).tolist() == [[0.0, pytest.approx(math.sqrt(5000)), 0.0]]


def test_whole_table_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    name = "op12_vector_codes"
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({SQL[name]})").fetchall()
    assert rows(QUERIES[name](spark, sf_dir), *COLUMNS) == sorted(want, key=repr)
