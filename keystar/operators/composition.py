"""Letter composition of text, long format."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.functions.scores import share_of_max
from keystar.functions.texts import letter_count, percent_of


def letter_composition(
    df: DataFrame,
    key: str,
    text: str,
    length: str,
    letters: str = K.RESIDUES,
    code: str = "amino_acid_code",
    share: str = "pct_of_sequence",
) -> DataFrame:
    """(key, letter, count, share of the stored length): a row per letter, zeros included.

    Counts are computed beside the text and only (letter, count) pairs are exploded, so the
    text is read once and never copied 20 times. No shuffle.
    """
    counts = F.array(
        *(
            F.struct(F.lit(x).alias("code"), letter_count(F.col(text), x).alias("n"))
            for x in letters
        )
    )
    return (
        df.where(F.length(text) > 0)
        .select(key, length, F.explode(counts).alias("c"))
        .select(
            key,
            F.col("c.code").alias(code),
            F.col("c.n").cast("long").alias("count"),
            percent_of(F.col("c.n"), F.col(length)).alias(share),
        )
    )


def category_rollup(
    composition: DataFrame,
    seed: DataFrame,
    key: str,
    code: str = "amino_acid_code",
    category: str = "category",
    share: str = "pct_of_sequence",
) -> DataFrame:
    """Share per (key, category)."""
    return (
        composition.join(seed.select(code, category), code)
        .groupBy(key, category)
        .agg(F.sum(share).alias(share))
    )


def with_bar(df: DataFrame, key: str, value: str, bar: str = "bar_pct") -> DataFrame:
    """Adds each value as a percentage of its key's largest value."""
    largest = F.max(value).over(Window.partitionBy(key))
    return df.withColumn(bar, share_of_max(F.col(value), largest))
