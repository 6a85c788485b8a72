"""Deduplication and max rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """One row per key, the first by ``order``; all NULL keys form one group.

    The rank filter is pushed below the shuffle (a per-task group limit), so a key
    holding most rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def ordered_distinct(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, values): the distinct values of each key by first appearance.

    Repeats collapse before anything is gathered, so a list is as long as its result.
    """
    firsts = df.groupBy(key, value).agg(F.min(order).alias("_first"))
    ranked = firsts.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("_first", value))).alias("_items")
    )
    return ranked.select(key, F.transform("_items", lambda x: x[value]).alias(f"{value}s"))


def restrict_to(df: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose columns match a key row: ``on`` maps df column -> key column."""
    names = {column: f"_k{i}" for i, column in enumerate(on)}
    right = keys.select(*(F.col(src).alias(names[column]) for column, src in on.items()))
    condition = [F.col(column) == F.col(alias) for column, alias in names.items()]
    return df.join(right, condition, "left_semi")


def pair_max(
    edges: DataFrame, a: str, b: str, score: str, keys_a: DataFrame, keys_b: DataFrame | None = None
) -> DataFrame:
    """Undirected edges: one row per pair (lower end first), best score, both ends known.

    ``keys_a`` and ``keys_b`` are one-column key relations for the two input columns; one
    relation for both when ``keys_b`` is missing.
    """
    if keys_b is not None:
        known = restrict_to(edges, keys_a, {a: keys_a.columns[0]})
        known = restrict_to(known, keys_b, {b: keys_b.columns[0]})
        return _collapse(known, a, b, score)
    # With one key relation the ends are interchangeable: collapse first, so the
    # restriction sees each pair once.
    pairs = _collapse(edges, a, b, score)
    pairs = restrict_to(pairs, keys_a, {a: keys_a.columns[0]})
    return restrict_to(pairs, keys_a, {b: keys_a.columns[0]})


def _collapse(edges: DataFrame, a: str, b: str, score: str) -> DataFrame:
    return (
        edges.where(F.col(a) != F.col(b))
        .groupBy(F.least(a, b).alias(a), F.greatest(a, b).alias(b))
        .agg(F.max(score).alias(score))
    )


def symmetric(edges: DataFrame, a: str, b: str, key: str, other: str) -> DataFrame:
    """Each undirected edge seen from both ends, so an ego lookup is an equi-join.

    Both views come out of one pass over the edges.
    """
    rest = [c for c in edges.columns if c not in (a, b)]
    there = F.struct(F.col(a).alias(key), F.col(b).alias(other))
    back = F.struct(F.col(b).alias(key), F.col(a).alias(other))
    return edges.select(*rest, F.inline(F.array(there, back))).select(key, other, *rest)


def max_evidence(
    evidence: DataFrame,
    bridge: DataFrame,
    foreign: str,
    anchor: str,
    subject: str,
    score: str,
    anchors: DataFrame,
    subjects: DataFrame | None = None,
    floor: Column | None = None,
) -> DataFrame:
    """Best score per (anchor, subject), foreign ids resolved through ``bridge``.

    Evidence is rolled up by foreign id and the bridge restricted to known anchors before the
    two meet; subjects are restricted after the rollup, when the rows are fewest.
    """
    links = bridge.select(foreign, anchor).where(F.col(anchor).isNotNull())
    links = restrict_to(links, anchors, {anchor: anchors.columns[0]})
    strongest = evidence.groupBy(foreign, subject).agg(F.max(score).alias(score))
    best = (
        strongest.join(links, foreign)
        .groupBy(anchor, subject)
        .agg(F.max(score).alias(score))
    )
    if floor is not None:
        best = best.where(F.col(score) >= floor)
    if subjects is not None:
        best = restrict_to(best, subjects, {subject: subjects.columns[0]})
    return best
