"""Prompts, responses and rewrites."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar.functions.json_text import has_unescaped_quotes, parse_status, parsed_object, string_field
from keystar.functions.texts import prompt
from keystar.operators.patch import apply_patch
from keystar.plans import rewrite as R
from keystar.session import scratch_path
from keystar.sources.storage import read_parquet, write_parquet
from workload.bronze import uniprot
from workload.registry import query, table, with_ctes
from workload.star import STAR_SQL, star

# Response text per event type: valid, fenced, wrong types, cut off, no JSON.
_RESPONSE = """
    SELECT event_id, user_id, CASE event_type
        WHEN 'view' THEN '{"function_friendly": "user ' || user_id || '", "tagline": "seen {' || event_id || '}"}'
        WHEN 'click' THEN 'Sure:' || chr(10) || '```json' || chr(10) || '{"function_friendly": null, "tagline": "c'
                          || user_id || '"}' || chr(10) || '```'
        WHEN 'purchase' THEN '{"function_friendly": ' || user_id || ', "tagline": true}'
        WHEN 'signup' THEN '{"function_friendly": "a "quoted" word ' || user_id || '"}'
        ELSE 'user ' || user_id || ' failed' END AS response
    FROM events"""


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    user, event, kind = F.col("user_id").cast("string"), F.col("event_id").cast("string"), F.col("event_type")
    text = (
        F.when(
            kind == "view",
            F.concat(F.lit('{"function_friendly": "user '), user, F.lit('", "tagline": "seen {'), event, F.lit('}"}')),
        )
        .when(
            kind == "click",
            F.concat(F.lit('Sure:\n```json\n{"function_friendly": null, "tagline": "c'), user, F.lit('"}\n```')),
        )
        .when(kind == "purchase", F.concat(F.lit('{"function_friendly": '), user, F.lit(', "tagline": true}')))
        .when(kind == "signup", F.concat(F.lit('{"function_friendly": "a "quoted" word '), user, F.lit('"}')))
        .otherwise(F.concat(F.lit("user "), user, F.lit(" failed")))
    )
    return table(spark, sf, "events").select("event_id", text.alias("response"))


_OBJECT = r"nullif(regexp_extract(response, '\{.*\}', 0, 's'), '')"


def _field(name: str) -> str:
    return f"""CASE WHEN json_valid({_OBJECT}) AND json_type({_OBJECT}, '$.{name}') = 'VARCHAR'
                    THEN json_extract_string({_OBJECT}, '$.{name}') END AS {name}"""


@query(
    "X8 X15 U5",
    rf"""SELECT event_id, {_field('function_friendly')}, {_field('tagline')},
               CASE WHEN coalesce(json_valid({_OBJECT}), false) THEN 'parsed' ELSE 'malformed' END AS status,
               coalesce(regexp_matches({_OBJECT},
                   '[a-zA-Z]"[a-zA-Z ]+"[a-zA-Z]|[a-zA-Z] "[a-zA-Z][a-zA-Z \-]*" '), false) AS inner_quotes
        FROM ({_RESPONSE})""",
)
def json_field_strict(spark: SparkSession, sf: str) -> DataFrame:
    response = F.col("response")
    parsed = _responses(spark, sf).withColumn("parsed", parsed_object(response))
    return parsed.select(
        "event_id",
        string_field(F.col("parsed"), "function_friendly").alias("function_friendly"),
        string_field(F.col("parsed"), "tagline").alias("tagline"),
        parse_status(response).alias("status"),
        has_unescaped_quotes(response).alias("inner_quotes"),
    )


@query(
    "X9",
    """SELECT p_partkey, concat_ws(chr(10),
                  'Gene: ' || CASE WHEN p_type <> 'PROMO' THEN nullif(p_brand, 'Brand#7') END,
                  'Protein: ' || nullif(p_name, 'red ring'),
                  CASE WHEN text <> '' THEN 'UniProt function text:' || chr(10) || text
                       ELSE 'UniProt function text: (none available)' END) AS prompt
       FROM part LEFT JOIN documents ON doc_id = p_partkey""",
)
def prompt_build(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    rows = table(spark, sf, "part").join(documents, F.col("p_partkey") == F.col("doc_id"), "left")
    symbol = F.when(F.col("p_type") != "PROMO", F.nullif(F.col("p_brand"), F.lit("Brand#7")))
    name = F.nullif(F.col("p_name"), F.lit("red ring"))
    return rows.select("p_partkey", prompt(symbol, name, F.col("text")).alias("prompt"))


def _stand_in(prompts: list[str]) -> list[str]:
    """Answers from the prompt alone: long ones in full, short ones without a tagline."""
    answers = []
    for text in prompts:
        lines = text.split("\n")
        tagline = lines[0] if len(lines) == 4 else None
        answers.append("```json\n" + json.dumps({"function_friendly": lines[-1], "tagline": tagline}) + "\n```")
    return answers


@query(
    "Q19 P24 P25 X9 X8",
    with_ctes(
        STAR_SQL,
        """SELECT primary_accession AS uniprot_accession, function_raw AS function_friendly,
                  CASE WHEN function_raw IS NOT NULL AND gene_symbol IS NOT NULL
                       THEN 'Gene: ' || gene_symbol END AS tagline, 'stand-in' AS model_id
           FROM b_uniprot""",
    ),
)
def rewrite_batch(spark: SparkSession, sf: str) -> DataFrame:
    source = star(spark, sf)["stg_uniprot"]
    return R.rewrite(source, _stand_in, "stand-in").drop("generated_at")


@query(
    "P24 Q19",
    with_ctes(
        STAR_SQL,
        """SELECT primary_accession AS uniprot_accession, function_raw AS function_friendly
           FROM b_uniprot ORDER BY primary_accession LIMIT 25""",
    ),
)
def rewrite_limited(spark: SparkSession, sf: str) -> DataFrame:
    """A trial run over the first keys."""
    source = star(spark, sf)["stg_uniprot"]
    return R.rewrite(source, _stand_in, "stand-in", limit=25).select(
        "uniprot_accession", "function_friendly"
    )


@query(
    "Q19 S8 S9",
    with_ctes(
        STAR_SQL,
        """SELECT least(25, count(*)) AS trial_keys, count(function_raw) AS answers,
                  0::BIGINT AS second_sent, count(function_raw) AS after_force,
                  true AS trial_not_sent_again
           FROM b_uniprot""",
    ),
)
def rewrite_resume(spark: SparkSession, sf: str) -> DataFrame:
    """A trial run, the rest, the same again, and all of it anew."""
    source = star(spark, sf)["stg_uniprot"]
    path = scratch_path(spark, "answers")
    trial = R.requests(source, 25)
    wanted = R.requests(source)
    first = R.send(trial, _stand_in, path, "stand-in")
    rest = R.send(wanted, _stand_in, path, "stand-in", partitions=4, waves=2)
    second = R.send(wanted, _stand_in, path, "stand-in")
    forced = R.send(wanted, _stand_in, path, "stand-in", force=True, partitions=4)
    answers = read_parquet(spark, path)
    counts = {
        "second_sent": second,
        "after_force": forced,
    }
    return answers.agg(F.count_distinct("uniprot_accession").alias("answers")).select(
        F.lit(trial.count()).cast("long").alias("trial_keys"),
        "answers",
        *(F.lit(v).cast("long").alias(k) for k, v in counts.items()),
        (F.lit(first + rest) == F.col("answers")).alias("trial_not_sent_again"),
    )


@query(
    "A17 Q19",
    with_ctes(
        STAR_SQL,
        """SELECT count(*) AS num_proteins, count(function_friendly) AS num_function_friendly,
                  count(tagline) AS num_taglines FROM b_llm_rewrites""",
    ),
)
def rewrite_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return R.rewrite_metrics(star(spark, sf)["stg_llm_rewrites"])


@query(
    "U5 X15",
    with_ctes(
        STAR_SQL,
        """SELECT primary_accession AS uniprot_accession FROM b_uniprot
           JOIN b_llm_rewrites r ON r.uniprot_accession = primary_accession
           WHERE r.function_friendly IS NULL AND function_raw IS NOT NULL AND protein_name LIKE '% ring'""",
    ),
)
def rewrite_redo(spark: SparkSession, sf: str) -> DataFrame:
    """Rings got a response with quotes inside a value, plates a null one, the rest a cut one."""
    tables = star(spark, sf)
    name = F.col("protein_name")
    text = (
        F.when(F.endswith(name, F.lit("ring")), '{"function_friendly": "the "binding" state"}')
        .when(F.endswith(name, F.lit("plate")), '{"function_friendly": null, "tagline": null}')
        .otherwise('{"function_friendly": "cut')
    )
    responses = tables["stg_uniprot"].select("uniprot_accession", text.alias("response"))
    redo = R.rows_to_redo(tables["stg_llm_rewrites"], responses, tables["stg_uniprot"])
    return redo.select("uniprot_accession")


@query(
    "U4 Q19",
    with_ctes(
        STAR_SQL,
        """SELECT r.uniprot_accession,
                  CASE WHEN protein_name LIKE '% ring' AND r.function_friendly IS NULL THEN 'redone'
                       ELSE r.function_friendly END AS function_friendly, r.tagline
           FROM b_llm_rewrites r JOIN b_uniprot ON primary_accession = r.uniprot_accession""",
    ),
)
def rewrite_patch(spark: SparkSession, sf: str) -> DataFrame:
    """The written relation patched in place."""
    path = scratch_path(spark, "rewrites")
    write_parquet(star(spark, sf)["stg_llm_rewrites"], path)
    old = read_parquet(spark, path)
    rings = uniprot(spark, sf).where(F.endswith("protein_name", F.lit("ring"))).select(
        F.col("primary_accession").alias("uniprot_accession")
    )
    patch = (
        old.where(F.col("function_friendly").isNull())
        .join(rings, "uniprot_accession", "left_semi")
        .select("uniprot_accession", F.lit("redone").alias("function_friendly"), "tagline")
    )
    apply_patch(spark, path, patch, "uniprot_accession")
    return read_parquet(spark, path)
