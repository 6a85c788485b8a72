"""Dimensions and facts. The anchor key is ``uniprot_accession``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar import constants as K
from keystar import schemas
from keystar.functions.texts import repair_dash, stage_phase
from keystar.operators.composition import letter_composition
from keystar.operators.dedup import max_evidence, pair_max, restrict_to, symmetric
from keystar.operators.median import grouped_median
from keystar.plans.diseases import disease_areas, nearest_area

ANCHOR = "uniprot_accession"


def amino_acids(spark: SparkSession) -> DataFrame:
    """The 20 standard residues in the seed's schema; the free-text notes are NULL."""
    rows = [(*row, None, None) for row in K.AMINO_ACIDS]
    return spark.createDataFrame(rows, schemas.SEED_AMINO_ACIDS)


def family_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.FAMILY_GROUPS, schemas.SEED_FAMILY_GROUPS)


def best_group(
    df: DataFrame, key: str, labels: str, groups: DataFrame, sep: str = ","
) -> DataFrame:
    """(key, group): the group of lowest priority among the labels of a multi-label text.

    ``groups`` has (label, group, priority); ties go to the group first in the alphabet.
    """
    label, group, priority = groups.columns
    known = groups.where(F.col(group).isNotNull())
    tokens = df.where(F.col(labels) != "").select(
        key, F.explode(F.split(labels, sep)).alias("_token")
    )
    return (
        tokens.withColumn("_token", F.trim("_token"))
        .join(known, F.col("_token") == F.col(label))
        .groupBy(key)
        .agg(F.min(F.struct(priority, group))[group].alias(group))
    )


def dim_protein(
    base: DataFrame,
    annotations: DataFrame,
    editorial: DataFrame,
    rewrites: DataFrame,
    groups: DataFrame,
) -> DataFrame:
    """One row per anchor with text from the best source that has any.

    All inputs share the join key, so the base is partitioned on it once for every join.
    """
    notes = annotations.select(ANCHOR, "protein_class", "subcellular_location")
    curated = editorial.select(
        ANCHOR,
        repair_dash(F.col("tagline")).alias("_ed_tagline"),
        repair_dash(F.col("function_friendly")).alias("_ed_text"),
        F.lit(True).alias("_curated"),
    )
    written = rewrites.select(
        ANCHOR, F.col("tagline").alias("_rw_tagline"), F.col("function_friendly").alias("_rw_text")
    )
    family = best_group(annotations, ANCHOR, "protein_class", groups)
    joined = base
    for side in (notes, curated, written, family):
        joined = joined.join(side, ANCHOR, "left")
    nothing = F.lit(K.NO_INFORMATION)
    return joined.select(
        ANCHOR,
        "gene_symbol",
        "protein_name",
        "sequence_length",
        "sequence",
        "pfam_id",
        F.coalesce("function_raw", nothing).alias("function_raw"),
        F.coalesce("_ed_text", "_rw_text", "function_raw", nothing).alias("function_friendly"),
        F.coalesce("_ed_tagline", "_rw_tagline", nothing).alias("tagline"),
        F.col("_curated").isNotNull().alias("is_curated"),
        "ensembl_gene_id",
        "string_protein_id",
        F.lit(None).cast("string").alias("chembl_target_id"),
        "protein_class",
        "subcellular_location",
        F.coalesce("family_group", F.lit(K.UNCLASSIFIED)).alias("family_group"),
        F.current_timestamp().alias("updated_at"),
    )


def dim_disease(diseases: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """One row per named disease; its area needs the ontology's ``terms`` (efo_id, parents)."""
    if terms is None:
        unknown = F.lit(None).cast("string").alias("therapeutic_area")
        return diseases.select("efo_id", "disease_name", unknown)
    areas = nearest_area(disease_areas(terms), diseases)
    return diseases.join(areas, "efo_id", "left").select(
        "efo_id", "disease_name", "therapeutic_area"
    )


def dim_drug(drugs: DataFrame, molecules: DataFrame) -> DataFrame:
    """One row per drug with the highest phase it reached; unnamed drugs stay."""
    phases = drugs.groupBy("chembl_id").agg(
        F.max(stage_phase(F.col("max_clinical_stage_raw"))).cast("smallint").alias("max_phase")
    )
    return phases.join(molecules, "chembl_id", "left").select(
        "chembl_id", "drug_name", "max_phase", "modality"
    )


def fact_protein_tissue(annotations: DataFrame, dim: DataFrame) -> DataFrame:
    return restrict_to(annotations, dim, {ANCHOR: ANCHOR}).select(
        ANCHOR,
        F.col("rna_tissue_specificity").alias("tissue"),
        F.col("rna_tissue_distribution").alias("expression_level"),
    )


def fact_interaction(edges: DataFrame, dim: DataFrame) -> DataFrame:
    return pair_max(edges, "uniprot_a", "uniprot_b", "combined_score", dim.select(ANCHOR))


def fact_protein_disease(
    associations: DataFrame, targets: DataFrame, dim: DataFrame, diseases: DataFrame
) -> DataFrame:
    return max_evidence(
        associations,
        targets,
        foreign="ensembl_gene_id",
        anchor=ANCHOR,
        subject="efo_id",
        score="overall_score",
        anchors=dim.select(ANCHOR),
        subjects=diseases.select("efo_id"),
        floor=F.lit(K.MIN_OVERALL_SCORE).cast("decimal(10,6)"),
    )


def fact_drug_target_disease(
    drugs: DataFrame, targets: DataFrame, dim: DataFrame, drug_dim: DataFrame | None = None
) -> DataFrame:
    """Distinct (drug, protein, disease); an entry without a disease id keeps its NULL.

    Without ``drug_dim`` the drugs are taken to be the dimension's own source, where every
    drug that has an id is known.
    """
    links = restrict_to(
        targets.where(F.col(ANCHOR).isNotNull()).select("ensembl_gene_id", ANCHOR),
        dim,
        {ANCHOR: ANCHOR},
    )
    # Repeats of a (drug, gene, disease) disappear before the bridge join.
    named = (
        drugs.select("chembl_id", "ensembl_gene_id", F.explode("disease_ids").alias("_d"))
        .select("chembl_id", "ensembl_gene_id", F.col("_d.diseaseId").alias("efo_id"))
        .distinct()
    )
    triples = named.join(links, "ensembl_gene_id").select("chembl_id", ANCHOR, "efo_id").distinct()
    if drug_dim is None:
        known = triples.where(F.col("chembl_id").isNotNull())
    else:
        known = restrict_to(triples, drug_dim, {"chembl_id": "chembl_id"})
    return known.withColumn("mechanism_of_action", F.lit(None).cast("string"))


def fact_bioactivity(
    activities: DataFrame, dim: DataFrame, drug_dim: DataFrame | None = None
) -> DataFrame:
    """(chembl_id, anchor, standard_type, pchembl_value, n_assays): the median over the assays.

    ``activities`` has one row per measurement with these first four columns; measurements
    without a comparable value, of unknown proteins or, with ``drug_dim``, of unknown drugs go.
    Many assays of one pair are normal and some are far off, hence the median.
    """
    known = restrict_to(activities.where(F.col("pchembl_value").isNotNull()), dim, {ANCHOR: ANCHOR})
    if drug_dim is not None:
        known = restrict_to(known, drug_dim, {"chembl_id": "chembl_id"})
    keys = ["chembl_id", ANCHOR, "standard_type"]
    return grouped_median(known, keys, "pchembl_value", "pchembl_value").select(
        *keys, "pchembl_value", F.col("n").alias("n_assays")
    )


def fact_protein_aa_composition(dim: DataFrame, residues: DataFrame) -> DataFrame:
    counted = letter_composition(dim, ANCHOR, "sequence", "sequence_length")
    return restrict_to(counted, residues, {"amino_acid_code": "amino_acid_code"})


def build_marts(t: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the dimensions and facts over the staging relations and seeds in ``t``."""

    def keys() -> DataFrame:
        # The base's keys are the dimension's keys, so facts restrict on the narrow relation.
        return t["stg_uniprot"].select(ANCHOR)

    def sequences() -> DataFrame:
        return t["stg_uniprot"].select(ANCHOR, "sequence", "sequence_length")

    return {
        "dim_protein": lambda: dim_protein(
            t["stg_uniprot"],
            t["stg_hpa"],
            t["dim_protein_editorial"],
            t["stg_llm_rewrites"],
            t["family_group_map"],
        ),
        "dim_disease": lambda: dim_disease(t["stg_ot_diseases"], t.get("disease_terms")),
        "dim_drug": lambda: dim_drug(t["stg_ot_drugs"], t["stg_ot_drug_molecules"]),
        "fact_protein_tissue": lambda: fact_protein_tissue(t["stg_hpa"], keys()),
        "fact_interaction": lambda: fact_interaction(t["stg_string"], keys()),
        "fact_protein_partner": lambda: symmetric(
            fact_interaction(t["stg_string"], keys()), "uniprot_a", "uniprot_b", ANCHOR, "accession"
        ),
        "fact_protein_disease": lambda: fact_protein_disease(
            t["stg_ot_associations"], t["stg_ot_targets"], keys(), t["stg_ot_diseases"]
        ),
        "fact_drug_target_disease": lambda: fact_drug_target_disease(
            t["stg_ot_drugs"], t["stg_ot_targets"], keys()
        ),
        "fact_protein_aa_composition": lambda: fact_protein_aa_composition(
            sequences(), t["seed_amino_acids"]
        ),
    }
