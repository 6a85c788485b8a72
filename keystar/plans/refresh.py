"""A new version of one source: what differs, whom it concerns, and the facts brought up to date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystar.plans.marts import ANCHOR, fact_interaction, fact_protein_disease
from keystar.session import stash
from keystar.sources.keyed import replace_keys


def _digest(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def changed_rows(old: DataFrame, new: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, change): rows that one version has more often than the other.

    Rows are compared by a digest of all columns; ``change`` is how often a row was added, or,
    below zero, taken away. A changed row is one of each. Order does not matter.
    """
    columns = sorted(new.columns)
    if columns != sorted(old.columns):
        raise ValueError(f"columns differ: {sorted(old.columns)} and {columns}")

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keep, _digest(columns).alias("_digest"), F.lit(sign).alias("_sign"))

    return (
        side(old, -1)
        .unionByName(side(new, 1))
        .groupBy(*keep, "_digest")
        .agg(F.sum("_sign").alias("change"))
        .where("change <> 0")
        .drop("_digest")
    )


def refresh_interaction(
    old: DataFrame, new: DataFrame, dim: DataFrame, path: str, buckets: int
) -> list[int]:
    """Brings the stored interaction fact from one version of the edges to the next.

    Only pairs with a changed edge are rolled up again, from all of their edges: a maximum can
    also fall. The fact is stored by ``uniprot_a``; the buckets that were rewritten are returned.
    """
    ends = [F.least("uniprot_a", "uniprot_b"), F.greatest("uniprot_a", "uniprot_b")]
    pair = [e.alias(n) for e, n in zip(ends, ("_a", "_b"), strict=True)]
    touched = changed_rows(old, new, ["uniprot_a", "uniprot_b"]).select(*pair).na.drop().distinct()
    touched = stash(touched, "touched")
    # Stored keys are pairs, but a bucket follows their first end: whole first ends are replaced.
    firsts = touched.select("_a").distinct()
    edges = new.withColumns({"_a": ends[0]}).join(firsts, "_a", "left_semi").drop("_a")
    again = fact_interaction(edges, dim)
    keys = firsts.select(F.col("_a").alias("uniprot_a"))
    return replace_keys(new.sparkSession, path, ["uniprot_a"], buckets, keys, again)


def refresh_disease(
    old: DataFrame,
    new: DataFrame,
    targets: DataFrame,
    dim: DataFrame,
    diseases: DataFrame,
    path: str,
    buckets: int,
) -> list[int]:
    """The same for the disease fact and its associations, stored by the anchor.

    Anchors that a changed association reaches through the bridge are rolled up again from all
    the associations of all their genes.
    """
    genes = changed_rows(old, new, ["ensembl_gene_id"]).select("ensembl_gene_id").distinct()
    links = targets.select("ensembl_gene_id", ANCHOR).where(F.col(ANCHOR).isNotNull()).distinct()
    anchors = stash(links.join(genes, "ensembl_gene_id", "left_semi").select(ANCHOR).distinct(), "anchors")
    bridge = stash(links.join(anchors, ANCHOR, "left_semi"), "bridge")
    evidence = new.join(bridge.select("ensembl_gene_id").distinct(), "ensembl_gene_id", "left_semi")
    again = fact_protein_disease(evidence, bridge, dim, diseases)
    return replace_keys(new.sparkSession, path, [ANCHOR], buckets, anchors, again)
