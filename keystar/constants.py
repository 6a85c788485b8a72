"""Lookup tables, thresholds, patterns and message formats."""

from __future__ import annotations

# --- fixed values: thresholds -------------------------------------------------------
MIN_COMBINED_SCORE = 700
MAX_COMBINED_SCORE = 1000
MIN_OVERALL_SCORE = "0.1"
LATE_PHASE = 3
TOP_PARTNERS = 20
TOP_DISEASES = 5
TOP_DRUGS = 5
NEIGHBOR_K = 20
NEIGHBORS_SHOWN = 10
SEARCH_LIMIT = 20
MAX_SEQUENCE = 1022
EMBED_BATCH = 128
EMBED_DIM = 1280
BOX_FRACTION = 0.03
VOLUME_FLOOR = 15000
MIN_FAMILY_GROUPS = 9
MAX_TOTAL_PCT = 100.5

# --- fixed values: texts ------------------------------------------------------------
NO_INFORMATION = "No information available"
UNCLASSIFIED = "Unclassified"
REPLACEMENT_CHAR = "�"
EM_DASH = "—"
SWISSPROT = "uniprot_swissprot"

# --- fixed values: alias sources that take part in id resolution ---------------------
SOURCE_HGNC = "Ensembl_HGNC_uniprot_ids"
SOURCE_ENSEMBL = "Ensembl_UniProt"
SOURCE_ACCESSION = "UniProt_AC"

# --- fixed values: clinical stage -> numeric phase (UNKNOWN and unseen stay NULL) -----
STAGE_PHASE = {
    "APPROVAL": 4,
    "PHASE_3": 3,
    "PHASE_2_3": 2,
    "PHASE_2": 2,
    "PHASE_1_2": 1,
    "PHASE_1": 1,
    "EARLY_PHASE_1": 0,
    "IND": 0,
    "PREAPPROVAL": 0,
    "PRECLINICAL": 0,
}
STAGES = [*STAGE_PHASE, "UNKNOWN"]

# --- fixed values: class token, family group, priority --------------------------------
FAMILY_GROUPS = [
    ("G-protein coupled receptors", "Receptors", 1),
    ("Nuclear receptors", "Receptors", 1),
    ("Voltage-gated ion channels", "Ion channels", 2),
    ("Transcription factors", "Transcription factors", 3),
    ("Immunoglobulin genes", "Immune", 4),
    ("T-cell receptor genes", "Immune", 4),
    ("Ribosomal proteins", "Ribosomal / translation", 5),
    ("Enzymes", "Enzymes", 6),
    ("Transporters", "Transporters", 7),
    ("Predicted secreted proteins", "Secreted", 8),
    ("Predicted membrane proteins", "Membrane", 9),
    ("Predicted intracellular proteins", "Intracellular", 10),
]

# --- fixed values: the 20 standard residues (letter, name, short name, side chain,
#     made by the body). Longer notes come from the user's own seed file. ---------------
AMINO_ACIDS = [
    ("A", "Alanine", "Ala", "Nonpolar aliphatic", True),
    ("R", "Arginine", "Arg", "Positively charged", True),
    ("N", "Asparagine", "Asn", "Polar uncharged", True),
    ("D", "Aspartate", "Asp", "Negatively charged", True),
    ("C", "Cysteine", "Cys", "Polar uncharged", True),
    ("E", "Glutamate", "Glu", "Negatively charged", True),
    ("Q", "Glutamine", "Gln", "Polar uncharged", True),
    ("G", "Glycine", "Gly", "Nonpolar aliphatic", True),
    ("H", "Histidine", "His", "Positively charged", False),
    ("I", "Isoleucine", "Ile", "Nonpolar aliphatic", False),
    ("L", "Leucine", "Leu", "Nonpolar aliphatic", False),
    ("K", "Lysine", "Lys", "Positively charged", False),
    ("M", "Methionine", "Met", "Nonpolar aliphatic", False),
    ("F", "Phenylalanine", "Phe", "Aromatic", False),
    ("P", "Proline", "Pro", "Nonpolar aliphatic", True),
    ("S", "Serine", "Ser", "Polar uncharged", True),
    ("T", "Threonine", "Thr", "Polar uncharged", False),
    ("W", "Tryptophan", "Trp", "Aromatic", False),
    ("Y", "Tyrosine", "Tyr", "Aromatic", True),
    ("V", "Valine", "Val", "Nonpolar aliphatic", False),
]
RESIDUES = "".join(row[0] for row in AMINO_ACIDS)

# --- fixed values: prompt lines and the unescaped-quote pattern -------------------------
PROMPT_GENE = "Gene: "
PROMPT_PROTEIN = "Protein: "
PROMPT_TEXT = "UniProt function text:\n"
PROMPT_NO_TEXT = "UniProt function text: (none available)"
QUOTE_PATTERN = r'[a-zA-Z]"[a-zA-Z ]+"[a-zA-Z]|[a-zA-Z] "[a-zA-Z][a-zA-Z \-]*" '

# --- fixed values: landed location of each bronze relation, below one root --------------
VERSIONS = {"uniprot": "2026_01", "string": "12.0", "hpa": "24", "opentargets": "26.03", "llm": "2026_06"}
BRONZE_GROUP = {
    "uniprot": "uniprot",
    "string": "string",
    "hpa": "hpa",
    "ot_targets": "opentargets",
    "ot_diseases": "opentargets",
    "ot_associations": "opentargets",
    "ot_drugs": "opentargets",
    "ot_drug_molecules": "opentargets",
    "llm_rewrites": "llm",
}
