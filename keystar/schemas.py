"""Declared schemas: landed sources, seeds and the columns of the built relations."""

from __future__ import annotations

from pyspark.sql import types as T

_s, _l, _i, _d, _b = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_value = _struct(value=_s)
_name = _struct(fullName=_value)

# One nested protein entry, restricted to the fields the flattening reads.
ENTRY = _struct(
    primaryAccession=_s,
    secondaryAccessions=T.ArrayType(_s),
    genes=T.ArrayType(_struct(geneName=_value)),
    proteinDescription=_struct(recommendedName=_name, submissionNames=T.ArrayType(_name)),
    sequence=_struct(value=_s, length=_l),
    comments=T.ArrayType(_struct(commentType=_s, texts=T.ArrayType(_value))),
    keywords=T.ArrayType(_struct(name=_s)),
    uniProtKBCrossReferences=T.ArrayType(
        _struct(database=_s, id=_s, properties=T.ArrayType(_struct(key=_s, value=_s)))
    ),
)

# A landed page wraps its entries.
ENTRY_PAGE = _struct(results=T.ArrayType(ENTRY))

UNIPROT = _struct(
    primary_accession=_s,
    secondary_accessions=T.ArrayType(_s),
    gene_symbol=_s,
    protein_name=_s,
    sequence_length=_l,
    sequence=_s,
    function_raw=_s,
    keywords=T.ArrayType(_s),
    pfam_ids=T.ArrayType(_s),
    ensembl_gene_ids=T.ArrayType(_s),
    string_ids=T.ArrayType(_s),
)

ALIASES = _struct(string_protein_id=_s, alias=_s, source=_s)

STRING_EDGES = _struct(uniprot_a=_s, uniprot_b=_s, combined_score=_i)

# Header in the landed file -> column.
HPA_COLUMNS = {
    "Gene": "gene_symbol",
    "Uniprot": "uniprot_accession",
    "Protein class": "protein_class",
    "RNA tissue specificity": "rna_tissue_specificity",
    "RNA tissue distribution": "rna_tissue_distribution",
    "Subcellular location": "subcellular_location",
    "Disease involvement": "disease_involvement",
}
HPA = _struct(**{column: _s for column in HPA_COLUMNS.values()})

OT_TARGETS = _struct(
    id=_s, approvedSymbol=_s, approvedName=_s, proteinIds=T.ArrayType(_struct(source=_s, id=_s))
)
OT_DISEASES = _struct(id=_s, name=_s)
OT_ASSOCIATIONS = _struct(diseaseId=_s, targetId=_s, associationScore=_d)
OT_DRUGS = _struct(
    drugId=_s,
    targetId=_s,
    diseases=T.ArrayType(_struct(diseaseFromSource=_s, diseaseId=_s)),
    maxClinicalStage=_s,
)
OT_DRUG_MOLECULES = _struct(id=_s, name=_s, drugType=_s)
LLM_REWRITES = _struct(uniprot_accession=_s, function_friendly=_s, tagline=_s)

# Bronze relation -> landed schema.
BRONZE = {
    "uniprot": UNIPROT,
    "string": STRING_EDGES,
    "hpa": HPA,
    "ot_targets": OT_TARGETS,
    "ot_diseases": OT_DISEASES,
    "ot_associations": OT_ASSOCIATIONS,
    "ot_drugs": OT_DRUGS,
    "ot_drug_molecules": OT_DRUG_MOLECULES,
    "llm_rewrites": LLM_REWRITES,
}

SEED_AMINO_ACIDS = _struct(
    amino_acid_code=_s,
    name=_s,
    three_letter_code=_s,
    category=_s,
    produced_by_body=_b,
    description=_s,
    deficiency_note=_s,
)
SEED_FAMILY_GROUPS = _struct(protein_class_token=_s, family_group=_s, priority=_i)
SEED_EDITORIAL = _struct(uniprot_accession=_s, tagline=_s, function_friendly=_s, is_curated=_b)

_score, _small, _time = T.DecimalType(10, 6), T.ShortType(), T.TimestampType()
_f = T.FloatType()

# Dimension, fact or seed -> the columns it is stored with.
MARTS = {
    "seed_amino_acids": SEED_AMINO_ACIDS,
    "family_group_map": SEED_FAMILY_GROUPS,
    "dim_protein_editorial": SEED_EDITORIAL,
    "dim_protein": _struct(
        uniprot_accession=_s,
        gene_symbol=_s,
        protein_name=_s,
        sequence_length=_l,
        sequence=_s,
        pfam_id=_s,
        function_raw=_s,
        function_friendly=_s,
        tagline=_s,
        is_curated=_b,
        ensembl_gene_id=_s,
        string_protein_id=_s,
        chembl_target_id=_s,
        protein_class=_s,
        subcellular_location=_s,
        family_group=_s,
        updated_at=_time,
    ),
    "dim_disease": _struct(efo_id=_s, disease_name=_s, therapeutic_area=_s),
    "dim_drug": _struct(chembl_id=_s, drug_name=_s, max_phase=_small, modality=_s),
    "fact_protein_tissue": _struct(uniprot_accession=_s, tissue=_s, expression_level=_s),
    "fact_interaction": _struct(uniprot_a=_s, uniprot_b=_s, combined_score=_i),
    "fact_protein_partner": _struct(uniprot_accession=_s, accession=_s, combined_score=_i),
    "fact_protein_disease": _struct(uniprot_accession=_s, efo_id=_s, overall_score=_score),
    "fact_drug_target_disease": _struct(
        chembl_id=_s, uniprot_accession=_s, efo_id=_s, mechanism_of_action=_s
    ),
    "fact_protein_aa_composition": _struct(
        uniprot_accession=_s, amino_acid_code=_s, count=_l, pct_of_sequence=_d
    ),
    "fact_embedding": _struct(
        uniprot_accession=_s,
        embedding=T.ArrayType(_f),
        umap_x=_f,
        umap_y=_f,
        model_version=_s,
        was_truncated=_b,
        computed_at=_time,
    ),
    "fact_protein_neighbor": _struct(
        uniprot_accession=_s, neighbor_accession=_s, similarity=_f, rank=_i
    ),
}
