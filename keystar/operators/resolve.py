"""Identifier resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from keystar import constants as K


def resolve_ids(
    aliases: DataFrame,
    key: str = "string_protein_id",
    alias: str = "alias",
    source: str = "source",
    ord: str = "ord",
    hgnc: str = K.SOURCE_HGNC,
    ensembl: str = K.SOURCE_ENSEMBL,
    accession: str = K.SOURCE_ACCESSION,
) -> DataFrame:
    """(id, accession): one alias per id by tier; ids without a usable alias are absent.

    1. an hgnc alias also listed by both other sources, else the first hgnc alias;
    2. the only ensembl row whose alias the accession source lists too;
    3. the first accession alias;
    4. the first ensembl alias.

    Two aggregations with partial combine stand in for gathering an id's rows: the first
    one collapses each (id, alias), the second picks the winners.
    """
    src, position = F.col(source), F.col(ord)
    per_alias = (
        aliases.where(src.isin(hgnc, ensembl, accession))
        .groupBy(F.col(key).alias("id"), F.col(alias).alias("alias"))
        .agg(
            F.min(F.when(src == hgnc, position)).alias("h"),
            F.min(F.when(src == accession, position)).alias("a"),
            F.min(F.when(src == ensembl, position)).alias("e"),
            F.count_if(src == ensembl).alias("e_rows"),
        )
    )
    both = F.col("a").isNotNull() & F.col("e").isNotNull()

    def first(order: Column, keep: Column | None = None) -> Column:
        """Alias with the lowest position among the rows that have one."""
        present = order.isNotNull() if keep is None else order.isNotNull() & keep
        return F.min(F.when(present, F.struct(order.alias("at"), F.col("alias"))))["alias"]

    picked = per_alias.groupBy("id").agg(
        first(F.col("h"), both).alias("h_both"),
        first(F.col("h")).alias("h_first"),
        F.coalesce(F.sum(F.when(both, F.col("e_rows"))), F.lit(0)).alias("n_both"),
        first(F.col("e"), both).alias("both_first"),
        first(F.col("a")).alias("a_first"),
        first(F.col("e")).alias("e_first"),
    )
    return picked.select(
        "id",
        F.coalesce(
            "h_both",
            "h_first",
            F.when(F.col("n_both") == 1, F.col("both_first")),
            "a_first",
            "e_first",
        ).alias("accession"),
    ).where(F.col("accession").isNotNull())


def with_ends(edges: DataFrame, mapping: DataFrame, a: str, b: str) -> DataFrame:
    """Edges with ``end_a`` and ``end_b`` looked up; a blank or missing mapping gives NULL."""
    known = mapping.select("id", "accession").where(
        F.col("accession").isNotNull() & (F.col("accession") != "")
    )
    left = known.select(F.col("id").alias("_ida"), F.col("accession").alias("end_a"))
    right = known.select(F.col("id").alias("_idb"), F.col("accession").alias("end_b"))
    return (
        edges.join(left, F.col(a) == F.col("_ida"), "left")
        .join(right, F.col(b) == F.col("_idb"), "left")
        .drop("_ida", "_idb")
    )


def unmapped() -> Column:
    return F.col("end_a").isNull() | F.col("end_b").isNull()


def resolve_edges(
    edges: DataFrame,
    mapping: DataFrame,
    a: str = "protein1",
    b: str = "protein2",
    score: str = "combined_score",
    min_score: int | None = None,
) -> tuple[DataFrame, Observation]:
    """(resolved edges, observation): edges with an unmapped end are dropped and counted.

    The observation fills ``kept`` and ``unmapped`` when the edges are first written. A stage
    that runs again after a lost executor counts its rows again; ``count_edges`` does not.
    """
    strong = _strong(edges, score, min_score)
    seen = Observation()
    looked_up = with_ends(strong, mapping, a, b).observe(
        seen, F.count_if(~unmapped()).alias("kept"), F.count_if(unmapped()).alias("unmapped")
    )
    kept = looked_up.where(~unmapped()).select(
        F.col("end_a").alias("uniprot_a"), F.col("end_b").alias("uniprot_b"), score
    )
    return kept, seen


def _strong(edges: DataFrame, score: str, min_score: int | None) -> DataFrame:
    return edges if min_score is None else edges.where(F.col(score) >= min_score)


def count_edges(
    edges: DataFrame,
    mapping: DataFrame,
    a: str = "protein1",
    b: str = "protein2",
    score: str = "combined_score",
    min_score: int | None = None,
) -> DataFrame:
    """One row (kept, unmapped) for edges that reach the score."""
    ends = with_ends(_strong(edges, score, min_score), mapping, a, b)
    return ends.agg(
        F.count_if(~unmapped()).alias("kept"), F.count_if(unmapped()).alias("unmapped")
    )


def match_symbols(
    rows: DataFrame, dim: DataFrame, symbol: str = "symbol", dim_symbol: str = "gene_symbol",
    key: str = "uniprot_accession",
) -> tuple[DataFrame, DataFrame]:
    """(matched rows with their key, unmatched rows); a symbol of several keys takes the lowest."""
    lookup = dim.groupBy(F.col(dim_symbol).alias("_symbol")).agg(F.min(key).alias(key))
    joined = rows.join(lookup, F.col(symbol) == F.col("_symbol"), "left").drop("_symbol")
    return joined.where(F.col(key).isNotNull()), joined.where(F.col(key).isNull()).drop(key)
