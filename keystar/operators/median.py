"""Exact medians per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystar.session import stash

# Distinct values of one group whose counts one task adds up.
VALUES = 100_000
# Ranges a group with more of them is cut into, round by round.
RANGES = 1024


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, into: str, most: int = VALUES
) -> DataFrame:
    """(keys, into, n): the median of the non-null values per group, and how many there are.

    Of an even number it is the mean of the middle two. Keys may be null. Values are counted
    per group and distinct value before anything is gathered, so a group costs what it has of
    distinct values, wherever its rows lie. A group with over ``most`` of them is narrowed
    first: its range is cut into equal parts, only counts per part are added up, and the parts
    with the middle values go on. A round leaves out at least the ends of the range.
    NaN counts as larger than any number, as it sorts. ``most`` is two at least.
    """
    names = list(keys)
    # Zeros of either sign are one value.
    number = (F.col(value).cast("double") + F.lit(0.0)).alias("v")
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.struct(*names).alias("group"), F.lit("").alias("path"), number)
        .agg(F.count("*").alias("c"))
    )
    counted = stash(counted, "counted")
    runs = counted.groupBy("group", "path").agg(
        F.sum("c").alias("n"), F.lit(0).cast("long").alias("below"), F.count("*").alias("distinct")
    )
    found = []
    while True:
        runs = stash(runs, "runs")
        few = runs.where(F.col("distinct") <= most)
        found.append(stash(_picked(counted.join(few, ["group", "path"])), "picked"))
        wide = runs.where(F.col("distinct") > most)
        if wide.isEmpty():
            break
        counted, runs = _narrowed(counted, wide)
    # A group whose middle two fell into different parts was picked in two halves.
    halves = reduce(DataFrame.unionByName, found)
    medians = halves.groupBy("group").agg(
        (F.sum("sum") / F.sum("halves")).alias(into), F.first("n").alias("n")
    )
    return medians.select(*(F.col("group")[k].alias(k) for k in names), into, "n")


def _middle() -> Column:
    """How many of the two middle ranks (one rank twice if n is odd) lie after before, up to after."""
    lower, upper = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1

    def inside(rank: Column) -> Column:
        return ((F.col("before") < rank) & (rank <= F.col("after"))).cast("int")

    return inside(lower) + inside(upper)


def _totalled(df: DataFrame, *order: str) -> DataFrame:
    """Ranks before and up to each row of a run, in the given order."""
    window = Window.partitionBy("group", "path").orderBy(*order)
    sofar = F.sum("c").over(window.rowsBetween(Window.unboundedPreceding, 0))
    with_after = df.withColumn("after", F.col("below") + sofar)
    return with_after.withColumn("before", F.col("after") - F.col("c"))


def _picked(values: DataFrame) -> DataFrame:
    """(group, n, sum, halves) of the middle values."""
    hit = _totalled(values, "v").withColumn("halves", _middle()).where("halves > 0")
    return hit.groupBy("group").agg(
        F.first("n").alias("n"),
        F.sum(F.col("v") * F.col("halves")).alias("sum"),
        F.sum("halves").alias("halves"),
    )


def _narrowed(counted: DataFrame, wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The values in those parts of wide runs that hold a middle rank, and these parts as runs."""
    v = F.col("v")
    infinite = float("inf")
    finite = ~F.isnan(v) & (F.abs(v) < infinite)
    kept = counted.join(wide.select("group", "path", "n", "below"), ["group", "path"])
    ends = kept.groupBy("group", "path").agg(
        F.min(F.when(finite, v)).alias("low"), F.max(F.when(finite, v)).alias("high")
    )
    # Halves keep the widest range finite; the part number never falls as the value grows.
    width = F.col("high") / 2 - F.col("low") / 2
    part = (
        F.when(F.isnan(v) | (v == infinite), RANGES + 1)
        .when(v == -infinite, -1)
        .when(width > 0, F.floor((v / 2 - F.col("low") / 2) / width * RANGES))
        .when(v == F.col("low"), 0)
        .otherwise(RANGES)
        .cast("int")
    )
    placed = kept.join(ends, ["group", "path"]).select(
        "group", "path", "n", "below", part.alias("part"), "v", "c"
    )
    placed = stash(placed, "placed")
    parts = placed.groupBy("group", "path", "n", "below", "part").agg(
        F.sum("c").alias("c"), F.count("*").alias("distinct")
    )
    chosen = stash(_totalled(parts, "part").where(_middle() > 0), "chosen")
    further = F.concat_ws("/", "path", "part").alias("path")
    values = placed.drop("n", "below").join(
        chosen.select("group", "path", "part"), ["group", "path", "part"]
    )
    runs = chosen.select("group", further, "n", F.col("before").alias("below"), "distinct")
    return values.select("group", further, "v", "c"), runs
