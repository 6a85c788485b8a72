"""Staging: one lazy view per bronze relation, renamed and flattened."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.functions.lists import first_element, first_where


def stg_uniprot(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("primary_accession").alias("uniprot_accession"),
        "gene_symbol",
        "protein_name",
        "sequence_length",
        "sequence",
        "function_raw",
        first_element(F.col("pfam_ids")).alias("pfam_id"),
        first_element(F.col("ensembl_gene_ids")).alias("ensembl_gene_id"),
        first_element(F.col("string_ids")).alias("string_protein_id"),
    )


def stg_hpa(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("uniprot_accession").isNotNull()).select(
        "uniprot_accession",
        "gene_symbol",
        "protein_class",
        "rna_tissue_specificity",
        "rna_tissue_distribution",
        "subcellular_location",
        "disease_involvement",
    )


def stg_string(bronze: DataFrame) -> DataFrame:
    return bronze.select("uniprot_a", "uniprot_b", "combined_score")


def stg_ot_targets(bronze: DataFrame) -> DataFrame:
    reviewed = first_where(F.col("proteinIds"), lambda p: p["source"] == K.SWISSPROT)
    return bronze.select(
        F.col("id").alias("ensembl_gene_id"),
        F.col("approvedSymbol").alias("gene_symbol"),
        F.col("approvedName").alias("gene_name"),
        reviewed["id"].alias("uniprot_accession"),
    )


def stg_ot_diseases(bronze: DataFrame) -> DataFrame:
    return bronze.select(F.col("id").alias("efo_id"), F.col("name").alias("disease_name")).na.drop()


def stg_ot_associations(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("targetId").alias("ensembl_gene_id"),
        F.col("diseaseId").alias("efo_id"),
        F.col("associationScore").cast("decimal(10,6)").alias("overall_score"),
    )


def stg_ot_drugs(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("drugId").alias("chembl_id"),
        F.col("targetId").alias("ensembl_gene_id"),
        F.col("diseases").alias("disease_ids"),
        F.col("maxClinicalStage").alias("max_clinical_stage_raw"),
    )


def stg_ot_drug_molecules(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("id").isNotNull()).select(
        F.col("id").alias("chembl_id"),
        F.col("name").alias("drug_name"),
        F.col("drugType").alias("modality"),
    )


def stg_llm_rewrites(bronze: DataFrame) -> DataFrame:
    return bronze.select("uniprot_accession", "function_friendly", "tagline")


# Staging relation -> (bronze relation, builder).
STAGING: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "stg_uniprot": ("uniprot", stg_uniprot),
    "stg_hpa": ("hpa", stg_hpa),
    "stg_string": ("string", stg_string),
    "stg_ot_targets": ("ot_targets", stg_ot_targets),
    "stg_ot_diseases": ("ot_diseases", stg_ot_diseases),
    "stg_ot_associations": ("ot_associations", stg_ot_associations),
    "stg_ot_drugs": ("ot_drugs", stg_ot_drugs),
    "stg_ot_drug_molecules": ("ot_drug_molecules", stg_ot_drug_molecules),
    "stg_llm_rewrites": ("llm_rewrites", stg_llm_rewrites),
}


def build_staging(bronze: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the staging relations."""
    return {
        name: (lambda source=source, builder=builder: builder(bronze[source]))
        for name, (source, builder) in STAGING.items()
    }
