"""The filter audit against removing documents one by one in every order."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from keystar.llm import filter_audit
from keystar.llm.filter_audit import audit
from keystar.llm.queries import QUERIES, SQL
from tests.conftest import rows

COLUMNS = [
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
    "good_lost", "toxic_lost", "shapley",
]


def failures(docs):
    found = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": doc_id is not None
            and any((t or "") == text and i is not None and i < doc_id for i, t, _ in docs),
        }
        found.append((doc_id, lang or "", {x for x, bad in failed.items() if bad}))
    return found


def plain(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    found, shapley = [], Counter()
    everything = failures(docs)
    for part in {p for _, p, _ in everything}:
        members = [(i, f) for i, p, f in everything if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [i for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                failing = sum(letter in f for _, f in members)
                alone = sum(f == {letter} for _, f in members)
                shapley[part, letter] += len(gone)
                found.append((
                    part, order, step, len(left), len(gone), failing - len(gone), alone,
                    sum(i in good for i in gone), sum(i in toxic for i in gone),
                ))
    return sorted(((*r, shapley[r[0], r[1][r[2] - 1]]) for r in found), key=repr)


LONG = " ".join(f"word{i}" for i in range(230))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (3, LONG, "de"), (4, LONG + " #", "en"),
    (5, None, "en"), (6, "", None), (7, "", ""), (None, "", "en"), (None, LONG, "fr"),
    (8, "A" * 40 + " " + LONG, "en"), (9, "a " * 300, "en"), (10, " \t\n\x0b\x0c\r", "en"),
    (11, "ein Übermaß | É " * 70, "de"), (12, "x" * 300_000, "de"), (13, "a b " * 200, "de"),
    (14, LONG.upper(), "en"), (4, "another text of the same id", "en"), (15, LONG + "\n", "en"),
    *((i, "copy $ " * 3, "es") for i in range(100, 140)),
]
LABELS = [
    (1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (4, 1, None), (8, 0, 1), (120, 1, 1),
    (None, 1, 1), (777, 1, 1),
]


@pytest.mark.parametrize("salt_rows", [1000, 7])
def test_odd_rows(spark, monkeypatch, salt_rows):
    monkeypatch.setattr(filter_audit, "SALT_ROWS", salt_rows)
    docs = spark.createDataFrame(
        [(i, t, x, "s", 0, "y") for i, t, x in DOCS],
        "doc_id long, text string, lang string, source string, mask int, part string",
    )
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert rows(audit(docs, labels), *COLUMNS) == plain(DOCS, LABELS)
    assert rows(audit(docs, labels.limit(0)), *COLUMNS) == plain(DOCS, [])
    assert rows(audit(docs.limit(0), labels)) == []


def test_whole_table_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    name = "op11_filter_audit"
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({SQL[name]})").fetchall()
    assert rows(QUERIES[name](spark, sf_dir), *COLUMNS) == sorted(want, key=repr)
