"""Story cards for all anchors at once, and what is derived from a card."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.functions.lists import keep_scored
from keystar.functions.scores import as_percent, fraction, phase_strength
from keystar.functions.texts import blank_to_null, display_label, phase_label
from keystar.operators.dedup import restrict_to, symmetric
from keystar.operators.ranking import nest, top_n
from keystar.plans.marts import ANCHOR

CARD_COLUMNS = [
    ANCHOR,
    "gene_symbol",
    "protein_name",
    "sequence_length",
    "sequence",
    "pfam_id",
    "function_raw",
    "function_friendly",
    "tagline",
    "is_curated",
    "protein_class",
    "subcellular_location",
    "family_group",
]
PARTNERS = "top_interaction_partners"
DISEASES = "top_diseases"
DRUGS = "approved_drugs"


# A one-column relation of keys, or a few of them as literals that reach the scans.
Keys = DataFrame | list[str] | None


def _only(df: DataFrame, keys: Keys) -> DataFrame:
    if keys is None:
        return df
    if isinstance(keys, list):
        return df.where(F.col(ANCHOR).isin(keys))
    return restrict_to(df, keys, {ANCHOR: keys.columns[0]})


def partners(edges: DataFrame, keys: Keys = None) -> DataFrame:
    """(anchor, accession, combined_score): each edge from both ends, or from the given keys.

    Keys restrict each end of the stored edges, so the whole relation is never doubled.
    """
    if keys is None:
        return symmetric(edges, "uniprot_a", "uniprot_b", ANCHOR, "accession")
    sides = [
        _only(
            edges.select(F.col(own).alias(ANCHOR), F.col(other).alias("accession"), "combined_score"),
            keys,
        )
        for own, other in (("uniprot_a", "uniprot_b"), ("uniprot_b", "uniprot_a"))
    ]
    return sides[0].unionByName(sides[1])


def top_partners(tables: Mapping[str, DataFrame], keys: Keys, n: int) -> DataFrame:
    """(anchor, rank, accession, gene_symbol, protein_name, combined_score).

    Reads the relation that is stored by anchor where the tables have it.
    """
    if "fact_protein_partner" in tables:
        seen = _only(tables["fact_protein_partner"], keys)
    else:
        seen = partners(tables["fact_interaction"], keys)
    best = top_n(seen, ANCHOR, n, F.desc("combined_score"), F.asc("accession"))
    names = tables["dim_protein"].select(
        F.col(ANCHOR).alias("accession"), "gene_symbol", "protein_name"
    )
    return best.join(names, "accession").withColumn(
        "combined_score", fraction(F.col("combined_score"))
    )


def top_diseases(tables: Mapping[str, DataFrame], keys: Keys, n: int) -> DataFrame:
    """(anchor, rank, efo_id, disease_name, overall_score)."""
    best = top_n(
        _only(tables["fact_protein_disease"], keys),
        ANCHOR,
        n,
        F.desc("overall_score"),
        F.asc("efo_id"),
    )
    names = tables["dim_disease"].select("efo_id", "disease_name")
    return best.join(names, "efo_id").withColumn(
        "overall_score", F.round("overall_score", 3).cast("double")
    )


def late_drugs(tables: Mapping[str, DataFrame], min_phase: int) -> DataFrame:
    return tables["dim_drug"].where(F.col("max_phase") >= min_phase)


def top_drugs(
    tables: Mapping[str, DataFrame], keys: Keys, n: int, min_phase: int
) -> DataFrame:
    """(anchor, rank, chembl_id, drug_name, max_phase)."""
    late = late_drugs(tables, min_phase).select("chembl_id", "drug_name", "max_phase")
    targets = _only(tables["fact_drug_target_disease"].select("chembl_id", ANCHOR), keys)
    drugs = targets.join(late, "chembl_id").distinct()
    return top_n(drugs, ANCHOR, n, F.desc("max_phase"), F.asc("chembl_id"))


def story_cards(
    tables: Mapping[str, DataFrame],
    keys: Keys = None,
    n_partners: int = K.TOP_PARTNERS,
    n_diseases: int = K.TOP_DISEASES,
    n_drugs: int = K.TOP_DRUGS,
    min_phase: int = K.LATE_PHASE,
) -> DataFrame:
    """One row per protein (or per key in ``keys``) with three ranked lists.

    Each list is limited before its names are joined and before anything is gathered. All
    joins share the anchor key, so the wide dimension is partitioned once. A missing list is
    empty.
    """
    base = _only(tables["dim_protein"], keys).select(*CARD_COLUMNS)
    tissue = tables["fact_protein_tissue"].select(
        ANCHOR,
        F.col("tissue").alias("tissue_specificity"),
        F.col("expression_level").alias("tissue_distribution"),
    )
    lists = [
        nest(
            top_partners(tables, keys, n_partners),
            ANCHOR,
            ["accession", "gene_symbol", "protein_name", "combined_score"],
            PARTNERS,
        ),
        nest(
            top_diseases(tables, keys, n_diseases),
            ANCHOR,
            ["efo_id", "disease_name", "overall_score"],
            DISEASES,
        ),
        nest(
            top_drugs(tables, keys, n_drugs, min_phase),
            ANCHOR,
            ["chembl_id", "drug_name", "max_phase"],
            DRUGS,
        ),
    ]
    cards = base.join(tissue, ANCHOR, "left")
    for items in lists:
        name = items.columns[1]
        empty = F.array().cast(items.schema[name].dataType)
        cards = cards.join(items, ANCHOR, "left").withColumn(name, F.coalesce(name, empty))
    return cards


def card_kpis(cards: DataFrame, threshold: float) -> DataFrame:
    """Connected entities, linked diseases and targeting drugs per card.

    Partners and diseases count from the threshold up; drugs have no score.
    """
    partners = F.size(keep_scored(F.col(PARTNERS), "combined_score", threshold))
    diseases = F.size(keep_scored(F.col(DISEASES), "overall_score", threshold))
    drugs = F.size(DRUGS)
    return cards.select(
        ANCHOR,
        (partners + diseases + drugs).alias("connected_entities"),
        diseases.alias("linked_diseases"),
        drugs.alias("targeted_drugs"),
    )


def ego_edges(cards: DataFrame, threshold: float) -> DataFrame:
    """(anchor, entity_type, id, label, detail, strength): the spokes around each protein.

    The three lists become one list per row, so the cards are read once.
    """

    def spoke(
        kind: str, id: Column, label: Column, detail: Column, strength: Column
    ) -> Column:
        return F.struct(
            F.lit(kind).alias("entity_type"),
            id.alias("id"),
            label.alias("label"),
            detail.alias("detail"),
            strength.cast("double").alias("strength"),
        )

    def percent(word: str, score: Column) -> Column:
        return F.concat(F.lit(f"{word} "), as_percent(score).cast("string"), F.lit("%"))

    partners = F.transform(
        keep_scored(F.col(PARTNERS), "combined_score", threshold),
        lambda p: spoke(
            "partner",
            p["accession"],
            F.coalesce(blank_to_null(p["gene_symbol"]), p["accession"]),
            percent("confidence", p["combined_score"]),
            p["combined_score"],
        ),
    )
    diseases = F.transform(
        keep_scored(F.col(DISEASES), "overall_score", threshold),
        lambda d: spoke(
            "disease",
            d["efo_id"],
            d["disease_name"],
            percent("evidence", d["overall_score"]),
            d["overall_score"],
        ),
    )
    drugs = F.transform(
        F.col(DRUGS),
        lambda d: spoke(
            "drug",
            d["chembl_id"],
            F.coalesce(blank_to_null(d["drug_name"]), d["chembl_id"]),
            phase_label(d["max_phase"]),
            phase_strength(d["max_phase"]),
        ),
    )
    return cards.select(ANCHOR, F.inline(F.concat(partners, diseases, drugs)))


def with_labels(df: DataFrame, key: str = ANCHOR) -> DataFrame:
    """Adds the display label of each protein."""
    label = display_label(F.col("gene_symbol"), F.col("protein_name"), F.col(key))
    return df.withColumn("label", label)
