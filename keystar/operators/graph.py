"""Walks over links between ids: what lies above a node, and where a forwarded id ends."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar.session import stash


def reached_from(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root, distance): every node below each root, the root itself at distance 0.

    ``edges`` has (child, parent), ``roots`` the column ``root``. A node may have several
    parents and lie below several roots; ``distance`` is the least number of steps. Each round
    goes one level down from what was new in the round before, so a cycle ends where it meets
    what is known, and the work is one join row per edge and root. Edges with a null end and
    loops are ignored. Rounds are as many as the graph is deep.
    """
    links = edges.select("child", "parent").where("child <> parent").distinct()
    links = stash(links, "links")
    frontier = roots.select(F.col("root").alias("node"), "root").na.drop().distinct()
    frontier = stash(frontier.withColumn("distance", F.lit(0)), "reached")
    known = frontier
    while not frontier.isEmpty():
        below = (
            frontier.join(links, F.col("node") == F.col("parent"))
            .select(F.col("child").alias("node"), "root", (F.col("distance") + 1).alias("distance"))
            .distinct()
            .join(known.select("node", "root"), ["node", "root"], "left_anti")
            .select("node", "root", "distance")
        )
        frontier = stash(below, "reached")
        known = known.unionByName(frontier)
    return known


def follow_forwards(links: DataFrame, current: DataFrame) -> DataFrame:
    """(id, resolved, targets, status) for every id of ``links`` that is not current.

    ``links`` has (old, new), ``current`` the column ``id``. Chains are followed by pointer
    jumping: every round replaces the end of a walk by that end's own walk, so a chain of n
    links takes log2(n) rounds. A current id is never left. ``resolved`` is set where exactly
    one current id is reached; ``status`` is then ``resolved``, and otherwise

    * ``split``: several current ids are reached (``targets`` of them),
    * ``cycle``: none is, and the walk runs into a cycle,
    * ``gone``: none is; the walk ends at an id that nothing replaces.

    Links with a null end, loops and repeated links are ignored.
    """
    known = current.select("id").na.drop().distinct()
    step = links.select("old", "new").where("old <> new").distinct()
    step = stash(step.join(known, F.col("old") == F.col("id"), "left_anti"), "forwards")
    olds = step.select(F.col("old").alias("end")).distinct()
    # A walk longer than there are links has met an id twice.
    rounds = math.ceil(math.log2(step.count() + 1)) + 1
    walks = step.select("old", F.col("new").alias("end"))
    for _ in range(rounds):
        walks = stash(walks, "walks")
        if walks.join(olds, "end", "left_semi").isEmpty():
            break
        onward = walks.select(F.col("old").alias("end"), F.col("end").alias("further"))
        walks = (
            walks.join(onward, "end", "left")
            .select("old", F.coalesce("further", "end").alias("end"))
            .distinct()
        )
    else:
        walks = stash(walks, "walks")
    ends = (
        walks.join(known.select(F.col("id").alias("end"), F.lit(True).alias("here")), "end", "left")
        .join(olds.withColumn("open", F.lit(True)), "end", "left")
        .groupBy(F.col("old").alias("id"))
        .agg(
            F.count("here").alias("targets"),
            F.min(F.when(F.col("here"), F.col("end"))).alias("first"),
            F.count("open").alias("open"),
        )
    )
    return ends.select(
        "id",
        F.when(F.col("targets") == 1, F.col("first")).alias("resolved"),
        "targets",
        F.when(F.col("targets") == 1, "resolved")
        .when(F.col("targets") > 1, "split")
        .when(F.col("open") > 0, "cycle")
        .otherwise("gone")
        .alias("status"),
    )


def forwarded(df: DataFrame, resolution: DataFrame, *columns: str) -> DataFrame:
    """``df`` with resolved ids in place of forwarded ones; other ids stay as they are."""
    names = df.columns
    table = resolution.where(F.col("resolved").isNotNull())
    for column in columns:
        new = table.select(F.col("id").alias("_old"), F.col("resolved").alias("_new"))
        df = df.join(new, F.col(column) == F.col("_old"), "left").withColumn(
            column, F.coalesce("_new", column)
        )
        df = df.select(*names)
    return df


def forwarded_unique(df: DataFrame, resolution: DataFrame, key: str) -> DataFrame:
    """The same where ``key`` names a row: an id's own row wins over rows forwarded to it.

    Of several forwarded rows the one with the least old id stays. Rows without a key go.
    """
    moved = forwarded(df.withColumn("_from", F.col(key)), resolution, key)
    rest = [c for c in df.columns if c != key]
    own = (F.col("_from") != F.col(key)).alias("moved")
    best = F.min_by(F.struct(*rest), F.struct(own, "_from")) if rest else F.first(key)
    picked = moved.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_row"))
    return picked.select(key, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)
