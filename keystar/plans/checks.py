"""The checks of the star, by relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.functions.texts import standard_length
from keystar.operators import quality as Q
from keystar.plans.marts import ANCHOR

FAMILY_DOMAIN = [*dict.fromkeys(group for _, group, _ in K.FAMILY_GROUPS), K.UNCLASSIFIED]

NOT_NULL = {
    "stg_uniprot": [ANCHOR, "sequence"],
    "stg_hpa": [ANCHOR],
    "stg_string": ["uniprot_a", "uniprot_b", "combined_score"],
    "stg_ot_targets": ["ensembl_gene_id"],
    "stg_ot_diseases": ["efo_id", "disease_name"],
    "stg_ot_associations": ["ensembl_gene_id", "efo_id", "overall_score"],
    "stg_ot_drugs": ["chembl_id", "ensembl_gene_id"],
    "stg_ot_drug_molecules": ["chembl_id"],
    "stg_llm_rewrites": [ANCHOR],
    "dim_protein": [ANCHOR, "protein_name", "sequence", "function_friendly", "tagline"],
    "dim_disease": ["efo_id", "disease_name"],
    "dim_drug": ["chembl_id"],
    "fact_protein_tissue": [ANCHOR],
    "fact_interaction": ["uniprot_a", "uniprot_b", "combined_score"],
    "fact_protein_disease": [ANCHOR, "efo_id", "overall_score"],
    "fact_protein_aa_composition": [ANCHOR, "amino_acid_code", "count", "pct_of_sequence"],
    "fact_drug_target_disease": ["chembl_id", ANCHOR],
    "dim_protein_editorial": [ANCHOR, "tagline", "is_curated"],
    "seed_amino_acids": [
        "amino_acid_code", "name", "three_letter_code", "category", "produced_by_body",
    ],
    "family_group_map": ["protein_class_token", "family_group", "priority"],
}

UNIQUE = {
    "stg_uniprot": [(ANCHOR,)],
    "stg_hpa": [(ANCHOR,)],
    "stg_ot_targets": [("ensembl_gene_id",)],
    "stg_ot_diseases": [("efo_id",)],
    "stg_ot_drug_molecules": [("chembl_id",)],
    "stg_llm_rewrites": [(ANCHOR,)],
    "dim_protein": [(ANCHOR,)],
    "dim_disease": [("efo_id",)],
    "dim_drug": [("chembl_id",)],
    "fact_protein_tissue": [(ANCHOR,)],
    "fact_protein_disease": [(ANCHOR, "efo_id")],
    "fact_drug_target_disease": [("chembl_id", ANCHOR, "efo_id")],
    "dim_protein_editorial": [(ANCHOR,)],
    "seed_amino_acids": [("amino_acid_code",), ("three_letter_code",)],
    "family_group_map": [("protein_class_token",)],
}

# (child relation, column, parent relation, column)
RELATIONSHIPS = [
    ("fact_protein_tissue", ANCHOR, "dim_protein", ANCHOR),
    ("fact_interaction", "uniprot_a", "dim_protein", ANCHOR),
    ("fact_interaction", "uniprot_b", "dim_protein", ANCHOR),
    ("fact_protein_disease", ANCHOR, "dim_protein", ANCHOR),
    ("fact_protein_disease", "efo_id", "dim_disease", "efo_id"),
    ("fact_protein_aa_composition", ANCHOR, "dim_protein", ANCHOR),
    ("fact_protein_aa_composition", "amino_acid_code", "seed_amino_acids", "amino_acid_code"),
    ("fact_drug_target_disease", "chembl_id", "dim_drug", "chembl_id"),
    ("fact_drug_target_disease", ANCHOR, "dim_protein", ANCHOR),
    ("fact_drug_target_disease", "efo_id", "dim_disease", "efo_id"),
]


def expected_residues(dim: DataFrame) -> DataFrame:
    return dim.where(F.length("sequence") > 0).select(
        ANCHOR, standard_length(F.col("sequence")).alias("standard_residues")
    )


def _column_checks() -> list[Q.Check]:
    checks: list[Q.Check] = []
    for relation, columns in NOT_NULL.items():
        for column in columns:
            checks.append(
                Q.RowCheck(
                    f"not_null_{relation}_{column}",
                    relation,
                    lambda column=column: F.col(column).isNull(),
                )
            )
    for relation, keys in UNIQUE.items():
        for key in keys:
            checks.append(Q.UniqueCheck(f"unique_{relation}_{'_'.join(key)}", relation, key))
    for child, column, parent, parent_column in RELATIONSHIPS:
        name = f"relationships_{child}_{column}"
        checks.append(Q.ReferenceCheck(name, child, column, parent, parent_column))
    return checks


def _outside(column: str, low: object, high: object) -> object:
    return lambda: (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high))


def described_seed() -> Q.Check:
    """For a residue seed of the user's own, whose descriptions are there to be shown."""
    return Q.RowCheck(
        "not_null_seed_amino_acids_description",
        "seed_amino_acids",
        lambda: F.col("description").isNull(),
    )


def star_checks() -> list[Q.Check]:
    floor = F.lit(K.MIN_OVERALL_SCORE).cast("decimal(10,6)")
    real = frozenset({Q.REAL_DATA})
    return [
        *_column_checks(),
        Q.RowCheck(
            "accepted_stages",
            "stg_ot_drugs",
            lambda: ~F.col("max_clinical_stage_raw").isin(*K.STAGES),
        ),
        Q.RowCheck("drug_phase_range", "dim_drug", _outside("max_phase", 0, 4)),
        Q.RowCheck(
            "interaction_score_range",
            "fact_interaction",
            _outside("combined_score", K.MIN_COMBINED_SCORE, K.MAX_COMBINED_SCORE),
        ),
        Q.RowCheck(
            "interaction_no_self_pairs",
            "fact_interaction",
            lambda: F.col("uniprot_a") == F.col("uniprot_b"),
        ),
        Q.RowCheck(
            "disease_score_range",
            "fact_protein_disease",
            lambda: (F.col("overall_score") < floor) | (F.col("overall_score") > 1),
        ),
        Q.RowCheck(
            "sequence_length_consistent",
            "dim_protein",
            lambda: (F.col("sequence_length") <= 0)
            | (F.col("sequence_length") != F.length("sequence")),
        ),
        Q.TableCheck(
            "interaction_canonical_pairs",
            lambda t: Q.canonical_pairs(t["fact_interaction"], "uniprot_a", "uniprot_b"),
        ),
        Q.TableCheck(
            "composition_complete",
            lambda t: Q.composition_complete(
                t["fact_protein_aa_composition"],
                expected_residues(t["dim_protein"]),
                ANCHOR,
                len(K.RESIDUES),
                K.MAX_TOTAL_PCT,
            ),
        ),
        Q.TableCheck(
            "protein_volume", lambda t: Q.volume_floor(t["dim_protein"], K.VOLUME_FLOOR), real
        ),
        Q.TableCheck(
            "family_group_valid",
            lambda t: Q.domain_and_spread(
                t["dim_protein"], ANCHOR, "family_group", FAMILY_DOMAIN, K.MIN_FAMILY_GROUPS
            ),
            real,
        ),
    ]
