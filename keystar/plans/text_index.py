"""Substring search that reads the postings of the query's trigrams instead of every row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.plans.lookup import search
from keystar.plans.marts import ANCHOR
from keystar.sources.keyed import BUCKET, bucket_of, write_keyed

SIZE = 3


def _grams(text: Column) -> Column:
    """The distinct trigrams of a text, in lower case as the search compares it."""
    low = F.lower(F.coalesce(text, F.lit("")))
    starts = F.filter(F.sequence(F.lit(0), F.length(low)), lambda i: i <= F.length(low) - SIZE)
    return F.array_distinct(F.transform(starts, lambda i: F.substring(low, i + 1, F.lit(SIZE))))


def postings(
    dim: DataFrame, symbol: str = "gene_symbol", name: str = "protein_name", key: str = ANCHOR
) -> DataFrame:
    """(gram, key, symbol, name): every row under each trigram of its three texts.

    A posting holds all that a search shows, so the dimension itself is not read again.
    """
    grams = F.array_distinct(F.concat(_grams(F.col(symbol)), _grams(F.col(name)), _grams(F.col(key))))
    return dim.select(F.explode(grams).alias("gram"), key, symbol, name)


def write_text_index(dim: DataFrame, path: str, buckets: int) -> None:
    """The postings below ``path``, in buckets of the trigram."""
    write_keyed(postings(dim), path, ["gram"], buckets)


def trigrams_of(query: str) -> list[str]:
    """Trigrams that every hit has: those of the runs between wildcards.

    Empty where the index cannot help: all runs shorter than three letters, or letters beyond
    ASCII, whose lower case could differ between the query and the index.
    """
    if not query.isascii():
        return []
    runs = re.split("[%_]", query.lower())
    return sorted({run[i : i + SIZE] for run in runs for i in range(len(run) - SIZE + 1)})


def read_postings(spark: SparkSession, path: str, grams: list[str], buckets: int) -> DataFrame:
    """The rows of the buckets in which the trigrams lie; no other file is opened."""
    asked = spark.createDataFrame([(g,) for g in grams], "gram string")
    numbers = [r[0] for r in asked.select(bucket_of(["gram"], buckets)).distinct().collect()]
    return spark.read.parquet(path).where(F.col(BUCKET).isin(numbers))


def search_indexed(
    dim: DataFrame, path: str, query: str, buckets: int, limit: int = K.SEARCH_LIMIT
) -> DataFrame:
    """The rows of ``lookup.search``, from the index where the query has a trigram.

    Rows that stand under all of the query's trigrams are the candidates; the search itself
    decides. Other queries scan the dimension.
    """
    grams = trigrams_of(query)
    if not grams:
        return search(dim, query, limit)
    found = read_postings(dim.sparkSession, path, grams, buckets).where(F.col("gram").isin(grams))
    rows = (
        found.groupBy(ANCHOR)
        .agg(
            F.count("*").alias("n"),
            F.first("gene_symbol").alias("gene_symbol"),
            F.first("protein_name").alias("protein_name"),
        )
        .where(F.col("n") == len(grams))
    )
    return search(rows, query, limit)
