from __future__ import annotations

import random

from pyspark.sql import functions as F

from keystar import constants as K
from keystar.operators import quality as Q
from keystar.plans import checks as C
from tests.conftest import rows


def test_column_checks_find_violations_and_pass_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 9), (None, None), (None, 3), ("z", -1)], "k string, n int")
    assert Q.not_null(df, "k").count() == 2
    assert rows(Q.unique(df, "k")) == [("a", 2)]
    assert Q.unique(df, "k", "n").count() == 0
    assert rows(Q.accepted_values(df, "k", ["a"]), "k") == [("z",)]
    assert rows(Q.in_domain(df, "k", ["a"]), "k") == [("z",), (None,), (None,)]
    assert rows(Q.in_range(df, "n", 0, 5), "n") == [(-1,), (9,)]
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert rows(Q.relationships(df, "k", parent, "p"), "k") == [("z",)]


def test_composite_keys_count_null_as_a_value(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x")], "k string, n string")
    assert rows(Q.unique(df, "k", "n")) == [("a", None, 2)]


def test_pairs(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "b"), ("d", "d")], "x string, y string")
    assert rows(Q.canonical_pairs(df, "x", "y")) == [
        ("a", "b", 2, "repeat"), ("c", "b", 1, "order"), ("d", "d", 1, "order"),
    ]
    assert rows(Q.no_self_pairs(df, "x", "y")) == [("d", "d")]


def test_volume_domain_and_lengths(spark):
    df = spark.createDataFrame([("p", "A", 1, "M"), ("q", None, 2, "M"), ("r", "?", 0, "")], "k string, g string, n int, s string")
    assert rows(Q.volume_floor(df, 4)) == [(3,)] and Q.volume_floor(df, 3).count() == 0
    assert rows(Q.domain_and_spread(df, "k", "g", ["A"], 3)) == [
        ("q", None, "unexpected_or_null_g"),
        ("r", "?", "unexpected_or_null_g"),
        (None, None, "fewer_than_3_distinct_gs"),
    ]
    assert rows(Q.length_matches(df, "n", "s"), "k") == [("q",), ("r",)]
    empty = df.limit(0)
    assert rows(Q.volume_floor(empty, 1)) == [(0,)]


def test_composition_reconciles(spark):
    comp = spark.createDataFrame(
        [("ok", 1, 50.0), ("ok", 1, 50.0), ("few", 1, 10.0), ("off", 1, 1.0), ("off", 1, 1.0), ("pct", 1, 60.0), ("pct", 1, 60.0)],
        "k string, count long, pct_of_sequence double",
    )
    expected = spark.createDataFrame([("ok", 2), ("few", 1), ("off", 3), ("pct", 2)], "k string, standard_residues int")
    assert rows(Q.composition_complete(comp, expected, "k", 2, K.MAX_TOTAL_PCT), "k") == [("few",), ("off",), ("pct",)]


def test_summary_and_tags(spark):
    tables = {"t": spark.createDataFrame([(1,), (None,), (7,)], "n int")}
    checks = [
        Q.RowCheck("null_n", "t", lambda: F.col("n").isNull()),
        Q.RowCheck("big_n", "t", lambda: F.col("n") > 5, frozenset({Q.REAL_DATA})),
        Q.TableCheck("volume", lambda t: Q.volume_floor(t["t"], 10), frozenset({Q.REAL_DATA})),
        Q.TableCheck("unique_n", lambda t: Q.unique(t["t"], "n")),
    ]
    assert rows(Q.summarize(checks, tables)) == [("big_n", 1), ("null_n", 1), ("unique_n", 0), ("volume", 1)]
    kept = Q.select_checks(checks, exclude=[Q.REAL_DATA])
    assert [c.name for c in kept] == ["null_n", "unique_n"]
    assert checks[0].violations(tables).count() == 1


def test_schema_differences(spark):
    df = spark.createDataFrame([], "a int, b string")
    wanted = spark.createDataFrame([], "a long, c string").schema
    assert len(Q.schema_differences(df, wanted)) == 3
    assert Q.schema_differences(df, df.schema) == []


def test_registry_names_are_unique():
    from pyspark.sql import SparkSession

    assert SparkSession.getActiveSession() is not None
    names = [c.name for c in C.star_checks()]
    assert len(names) == len(set(names))
    assert C.FAMILY_DOMAIN[0] == "Receptors" and len(C.FAMILY_DOMAIN) == 11


def test_coverage(spark):
    a = spark.range(3)
    b = spark.createDataFrame([(1, None), (2, 0.5)], "id int, x double")
    assert rows(Q.coverage(a, b, {"null_x": F.col("x").isNull()})) == [(3, 2, 1)]


def test_key_checks_share_a_shuffle(spark):
    rng = random.Random(4)

    def frame(n, schema):
        return spark.createDataFrame(
            [(rng.choice([None, *range(12)]), rng.choice([None, "a", "b"]), rng.randrange(30)) for _ in range(n)],
            schema,
        )

    tables = {
        "child": frame(60, "a int, b string, c int"),
        "parent": frame(9, "a int, b string, c int"),
        "none": frame(0, "a int, b string, c int"),
    }
    checks = [
        Q.UniqueCheck("one", "child", ("c",)),
        Q.UniqueCheck("two", "child", ("a", "b")),
        Q.UniqueCheck("null", "parent", ("a",)),
        Q.UniqueCheck("empty", "none", ("a",)),
        Q.ReferenceCheck("ref_a", "child", "a", "parent", "a"),
        Q.ReferenceCheck("ref_b", "child", "b", "parent", "b"),
        Q.ReferenceCheck("ref_none", "child", "c", "none", "c"),
        Q.ReferenceCheck("from_none", "none", "c", "child", "c"),
        Q.ReferenceCheck("itself", "parent", "a", "parent", "a"),
    ]
    found = Q.summarize(checks, tables)
    assert dict(rows(found)) == {c.name: c.violations(tables).count() for c in checks}
    plan = Q.summarize(checks, tables)._jdf.queryExecution().executedPlan().toString()
    # One by check and key, one by check, and the few names.
    assert plan.count("Exchange hashpartitioning") <= 3, plan
