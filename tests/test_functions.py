from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.functions import json_text, lists, scores, texts, vectors
from keystar.operators.composition import category_rollup, letter_composition, with_bar
from tests.conftest import rows


def one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_composition_of_known_sequence(spark):
    df = spark.createDataFrame(
        [("T", "ACDACA", 6), ("empty", "", 0), ("none", None, None), ("zero", "A", 0)], "k string, s string, n long"
    )
    got = {(r["k"], r["amino_acid_code"]): (r["count"], r["pct_of_sequence"])
           for r in letter_composition(df, "k", "s", "n").collect()}
    assert got[("T", "A")] == (3, 50.0)
    assert got[("T", "C")] == (2, 33.33)
    assert got[("T", "D")] == (1, 16.67)
    assert sum(1 for (k, _), v in got.items() if k == "T" and v == (0, 0.0)) == 17
    assert got[("zero", "A")] == (1, None)
    assert {k for k, _ in got} == {"T", "zero"}


def test_letter_count_matches_characters(spark):
    df = spark.createDataFrame([("éAßA→A",), ("",), ("→→",)], "s string")
    ascii_, wide = texts.letter_count(F.col("s"), "A"), texts.letter_count(F.col("s"), "→")
    assert [tuple(r) for r in df.select(ascii_, wide).collect()] == [(3, 1), (0, 0), (0, 2)]


def test_rollup_and_bars(spark):
    comp = spark.createDataFrame(
        [("p", "A", 10.0), ("p", "G", 5.0), ("p", "R", 30.0), ("z", "A", 0.0)],
        "k string, amino_acid_code string, pct_of_sequence double",
    )
    seed = spark.createDataFrame(
        [("A", "nonpolar"), ("G", "nonpolar"), ("R", "positive")], "amino_acid_code string, category string"
    )
    out = with_bar(category_rollup(comp, seed, "k"), "k", "pct_of_sequence")
    assert rows(out) == [("p", "nonpolar", 15.0, 50.0), ("p", "positive", 30.0, 100.0), ("z", "nonpolar", 0.0, 0.0)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"function_friendly": "It does X.", "tagline": "Short."}', ("It does X.", "Short.")),
        ("not json at all", (None, None)),
        ('{"function_friendly": null, "tagline": null}', (None, None)),
        ('{"function_friendly": "It does X."}', ("It does X.", None)),
        ('\n  {"function_friendly": "a", "tagline": "b"}\n', ("a", "b")),
        ('["not", "a", "dict"]', (None, None)),
        ('{"function_friendly": 42, "tagline": true}', (None, None)),
        ("", (None, None)),
        ('```json\n{"function_friendly": "a",\n "tagline": "b"}\n```', ("a", "b")),
        ('{"function_friendly": "a" "b"}', (None, None)),
        ("} reversed {", (None, None)),
        ('{"function_friendly": {"x": "y"}, "tagline": ["t"]}', (None, None)),
        (None, (None, None)),
    ],
)
def test_only_json_strings_are_taken(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").withColumn("v", json_text.parsed_object(F.col("t")))
    fields = [json_text.string_field(F.col("v"), f) for f in ("function_friendly", "tagline")]
    assert tuple(df.select(*fields).first()) == expected


def test_status_and_inner_quotes(spark):
    broken = '{"function_friendly": "the "open" state"}'
    df = spark.createDataFrame([(broken,), ('{"a": null}',), ('{"a": "cut',), (None,)], "t string")
    got = df.select(json_text.parse_status(F.col("t")), json_text.has_unescaped_quotes(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        ("malformed", True), ("parsed", False), ("malformed", False), ("malformed", False),
    ]


def test_prompt_omits_missing_lines(spark):
    df = spark.createDataFrame(
        [("EGFR", "Receptor", "Grows."), ("EGFR", "Receptor", None), (None, "P", "Does."), ("", "", ""), (None,) * 3],
        "g string, n string, t string",
    )
    got = [r[0] for r in df.select(texts.prompt(F.col("g"), F.col("n"), F.col("t"))).collect()]
    assert got == [
        "Gene: EGFR\nProtein: Receptor\nUniProt function text:\nGrows.",
        "Gene: EGFR\nProtein: Receptor\nUniProt function text: (none available)",
        "Protein: P\nUniProt function text:\nDoes.",
        "UniProt function text: (none available)",
        "UniProt function text: (none available)",
    ]


def test_truncation_boundary(spark):
    df = spark.createDataFrame([("abc",), ("abcd",), ("abcde",)], "s string")
    clipped, flag = texts.truncated(F.col("s"), 4)
    assert [tuple(r) for r in df.select(clipped, flag).collect()] == [
        ("abc", False), ("abcd", False), ("abcd", True),
    ]


def test_stage_and_phase(spark):
    df = spark.createDataFrame([(s,) for s in [*K.STAGES, "NEW", None]], "s string")
    got = [r[0] for r in df.select(texts.stage_phase(F.col("s"))).collect()]
    assert got == [4, 3, 2, 2, 1, 1, 0, 0, 0, 0, None, None, None]
    phases = spark.createDataFrame([(4,), (3,), (2,), (0,), (None,)], "p int")
    assert [r[0] for r in phases.select(texts.phase_label(F.col("p"))).collect()] == [
        "Approved", "Late-stage trials", "Phase 2", "Phase 0", "In development",
    ]
    assert [r[0] for r in phases.select(scores.phase_strength(F.col("p"))).collect()] == [1.0, 0.75, 0.5, 0.0, 0.0]


def test_labels(spark):
    df = spark.createDataFrame(
        [("INS", "Insulin", "P1"), ("INS", None, "P1"), (None, "Insulin", "P1"), (None, None, None), ("", "", "P2")],
        "g string, n string, k string",
    )
    got = [r[0] for r in df.select(texts.display_label(F.col("g"), F.col("n"), F.col("k"))).collect()]
    assert got == ["INS (Insulin)", "INS", "P1", "?", "P2"]


def test_chips(spark):
    df = spark.createDataFrame([(" a, b ,,\tc , ",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(lists.split_labels(F.col("s"))).collect()] == [["a", "b", "c"], [], []]


def test_percent_rounds_half_to_even_and_clamps(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (1.5,), (-1.0,), (0.005,)], "x double")
    assert [r[0] for r in df.select(scores.as_percent(F.col("x"))).collect()] == [12, 14, 100, 0, 0]


def test_wildcards_and_escape_in_search_text(spark):
    df = spark.createDataFrame([("a_b",), ("axb",), ("a\\b",), ("A%B",), (None,)], "s string")
    hits = lambda q: [r[0] for r in df.where(texts.any_of(texts.contains_text(F.col("s"), q))).collect()]
    assert hits("a_b") == ["a_b", "axb", "a\\b", "A%B"]
    assert hits("a\\b") == ["a\\b"]
    assert hits("%") == ["a_b", "axb", "a\\b", "A%B"]


def test_repair_and_fold(spark):
    assert one(spark, texts.repair_dash(F.col("x")), value="a�b") == "a—b"
    assert one(spark, texts.fold_domain(F.col("x"), ["a"]), value="b") == "Unclassified"
    assert one(spark, texts.fold_domain(F.col("x"), ["a"]), value=None) == "Unclassified"
    assert one(spark, texts.standard_length(F.col("x")), value="ACXU-a") == 2


def test_sorted_and_filtered_lists(spark):
    df = spark.createDataFrame(
        [([("b", 1.0), ("a", 1.0), ("c", None), ("d", 3.0)],)], "xs array<struct<k:string,s:double>>"
    )
    ordered = lists.sort_by_score(F.col("xs"), "s", "k")
    assert [x["k"] for x in df.select(ordered).first()[0]] == ["d", "a", "b", "c"]
    assert [x["k"] for x in df.select(lists.keep_scored(F.col("xs"), "s", 1.0)).first()[0]] == ["b", "a", "d"]


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [6.0, 8.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = df.select(vectors.norm(F.col("a")), vectors.cosine(F.col("a"), F.col("b")), vectors.unit(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(5.0, 1.0, [0.6, 0.8]), (0.0, None, None)]
