"""Documents to packed training sequences, one operator of ``keystar.llm`` per stage.

Every stage takes all that its predecessor kept. The first three return rows of ``documents``;
the last returns where each piece of the documents that are left stands in a sequence.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar.llm.common import unused
from keystar.llm.exact_dedup import dedup
from keystar.llm.packing import pack
from keystar.llm.simhash import near_survivors
from keystar.llm.toxicity import without_toxic
from keystar.session import stash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"


def _name() -> Column:
    """The id of a row, or a negative number from its text where it has none."""
    own = -F.abs(F.xxhash64("text") % (1 << 61)) - 1
    return F.coalesce(F.col("doc_id").cast("long"), own)


def _digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def _one_each(docs: DataFrame, chosen: DataFrame, **keys: Column) -> DataFrame:
    """One row of ``docs`` for each key in ``chosen``; rows that share a key are one document."""
    own = {key: unused(docs, key) for key in keys}
    named = docs.withColumns({own[key]: value for key, value in keys.items()})
    found = named.join(chosen.withColumnsRenamed(own), list(own.values()))
    return found.dropDuplicates(list(own.values())).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    named = docs.select(_name().alias("doc_id"), "text")
    groups = dedup(named, F.xxhash64("doc_id") > 0).where("kept")
    kept = groups.select(F.col("doc_id").alias("_name"), F.col("text_sha256").alias("_digest"))
    return _one_each(docs, kept.distinct(), _name=_name(), _digest=_digest())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays, of its texts the least digest."""
    named = docs.select(_name().alias("doc_id"), "text", _digest().alias("_digest"))
    kept = near_survivors(named, "_digest").withColumnRenamed("doc_id", "_name")
    return _one_each(docs, kept, _name=_name(), _digest=_digest())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, placed in training sequences."""
    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

# Scores, fingerprints and packings have no SQL; a test runs the stages by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the whole documents table; each is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
