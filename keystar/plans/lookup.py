"""Search, listings, the map extract, composition and neighbour lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.functions.texts import any_of, contains_text, fold_domain, starts_with_text
from keystar.operators.dedup import restrict_to
from keystar.operators.ranking import top_n
from keystar.plans.cards import late_drugs
from keystar.plans.marts import ANCHOR


def search(
    dim: DataFrame,
    query: str,
    limit: int = K.SEARCH_LIMIT,
    symbol: str = "gene_symbol",
    name: str = "protein_name",
    key: str = ANCHOR,
) -> DataFrame:
    """Rows containing the text in symbol, name or key; prefix hits, then short names, first.

    ``%`` and ``_`` in the query act as wildcards. Ties go to the lower key.
    """
    columns = [F.col(symbol), F.col(name), F.col(key)]
    prefixed = any_of(*(starts_with_text(c, query) for c in columns))
    return (
        dim.where(any_of(*(contains_text(c, query) for c in columns)))
        .orderBy(
            F.when(prefixed, 0).otherwise(1), F.length(F.coalesce(F.col(name), F.lit(""))), key
        )
        .limit(limit)
        .select(key, symbol, name)
    )


def list_proteins(dim: DataFrame) -> DataFrame:
    return dim.select(ANCHOR, "gene_symbol", "protein_name")


def map_extract(tables: Mapping[str, DataFrame], min_phase: int = K.LATE_PHASE) -> DataFrame:
    """Every embedded protein with its coordinates and its disease and late-drug counts."""
    points = tables["fact_embedding"].select(ANCHOR, "umap_x", "umap_y")
    diseases = tables["fact_protein_disease"].groupBy(ANCHOR).agg(
        F.count(F.lit(1)).alias("disease_count")
    )
    late = late_drugs(tables, min_phase).select("chembl_id")
    drugs = (
        tables["fact_drug_target_disease"]
        .select(ANCHOR, "chembl_id")
        .join(late, "chembl_id", "left_semi")
        .groupBy(ANCHOR)
        .agg(F.count_distinct("chembl_id").alias("drug_count"))
    )
    return (
        tables["dim_protein"]
        .select(ANCHOR, "gene_symbol", "family_group")
        .join(points, ANCHOR)
        .join(diseases, ANCHOR, "left")
        .join(drugs, ANCHOR, "left")
        .na.fill(0, ["disease_count", "drug_count"])
    )


def fold_groups(points: DataFrame, known: list[str]) -> DataFrame:
    """Family groups outside the known set become unclassified."""
    return points.withColumn("family_group", fold_domain(F.col("family_group"), known))


def box_around(
    points: DataFrame,
    key: str,
    center: object,
    x: str = "umap_x",
    y: str = "umap_y",
    fraction: float = K.BOX_FRACTION,
) -> DataFrame:
    """Points within ``fraction`` of the whole extent of a chosen point, per axis.

    Extent and centre are one-row subqueries; an unknown centre gives no rows.
    """
    extent = points.agg(
        (F.max(x) - F.min(x)).alias("width"), (F.max(y) - F.min(y)).alias("height")
    )
    at = points.where(F.col(key) == F.lit(center)).agg(F.min(x).alias("cx"), F.min(y).alias("cy"))
    half_w = extent.select("width").scalar() * F.lit(fraction)
    half_h = extent.select("height").scalar() * F.lit(fraction)
    cx, cy = at.select("cx").scalar(), at.select("cy").scalar()
    return points.where(
        F.col(x).between(cx - half_w, cx + half_w) & F.col(y).between(cy - half_h, cy + half_h)
    )


def composition(
    composed: DataFrame, residues: DataFrame, keys: DataFrame | None = None
) -> DataFrame:
    """Composition rows with the residue's description, by key, richest first."""
    rows = composed if keys is None else restrict_to(composed, keys, {ANCHOR: keys.columns[0]})
    return (
        rows.join(residues, "amino_acid_code")
        .select(ANCHOR, *residues.columns, "count", "pct_of_sequence")
        .orderBy(ANCHOR, F.desc("pct_of_sequence"), "amino_acid_code")
    )


def lengths(dim: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, sequence_length) for the wanted keys; no keys, no rows."""
    return restrict_to(dim.select(ANCHOR, "sequence_length"), keys, {ANCHOR: keys.columns[0]})


def neighbors_of(
    neighbors: DataFrame, dim: DataFrame, keys: DataFrame | None = None, k: int = K.NEIGHBORS_SHOWN
) -> DataFrame:
    """The first ``k`` neighbours of each key with their names; ``k`` counts known neighbours.

    Ranks are dense per key, so a rank filter stands in for a sort and limit.
    """
    wanted = (
        neighbors if keys is None else restrict_to(neighbors, keys, {ANCHOR: keys.columns[0]})
    )
    names = dim.select(F.col(ANCHOR).alias("accession"), "gene_symbol", "protein_name")
    named = wanted.join(names, F.col("neighbor_accession") == F.col("accession"))
    shown = top_n(named, ANCHOR, k, F.asc("rank"), F.asc("accession"), rank="position")
    return shown.select(
        ANCHOR,
        "rank",
        "accession",
        "gene_symbol",
        "protein_name",
        F.bround(F.col("similarity").cast("double"), 3).alias("similarity"),
    )
