"""Top-N per key and nested lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, key: str, n: int, *order: Column, rank: str = "rank") -> DataFrame:
    """At most ``n`` rows per key with their rank.

    ``order`` must be total. Each task keeps its own best ``n`` per key before the shuffle,
    so a hub key costs n rows per task however many rows it has.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def nest(ranked: DataFrame, key: str, fields: Sequence[str], into: str, rank: str = "rank") -> DataFrame:
    """Ranked rows of each key as one list of structs in rank order (bounded by top_n)."""
    packed = F.array_sort(F.collect_list(F.struct(rank, F.struct(*fields).alias("item"))))
    return (
        ranked.groupBy(key)
        .agg(packed.alias(into))
        .select(key, F.transform(into, lambda x: x["item"]).alias(into))
    )


def flatten_list(df: DataFrame, key: str, items: str) -> DataFrame:
    """(key, rank, item fields) of a nested list; keys with an empty list have no rows."""
    return df.select(key, F.posexplode(items).alias("pos", "item")).select(
        key, (F.col("pos") + 1).alias("rank"), "item.*"
    )
