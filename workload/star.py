"""The star and its serving queries over bronze derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar import constants as K
from keystar import schemas
from keystar.operators.composition import category_rollup, with_bar
from keystar.operators.quality import schema_differences
from keystar.operators.ranking import flatten_list
from keystar.plans import cards, lookup
from keystar.plans.marts import ANCHOR, amino_acids
from keystar.plans.tables import Tables
from keystar.plans.text_index import search_indexed, write_text_index
from keystar.plans.warehouse import build_star
from keystar.session import scratch_path, stash
from keystar.sources.storage import empty_sources, read_parquet, write_parquet
from workload import bronze as B
from workload.registry import query, with_ctes


def star(spark: SparkSession, sf: str) -> Tables:
    tables = build_star(spark, B.bronze(spark, sf), B.editorial(spark, sf))
    return tables.extended({"fact_embedding": lambda: B.fact_embedding(spark, sf)})


# Materialised marts of each (application, data set), as serving queries expect them.
_served: dict[tuple[str, str], Tables] = {}


def served(spark: SparkSession, sf: str) -> Tables:
    """The star with its dimensions and facts written on first use, for queries that serve them."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _served:
        tables = star(spark, sf)

        def written(name: str) -> DataFrame:
            return stash(tables[name], name)

        marts = [n for n in tables if n.startswith(("dim_", "fact_"))]
        _served[at] = tables.extended({n: (lambda n=n: written(n)) for n in marts})
    return _served[at]


_families = ", ".join(f"('{t}', '{g}', {p})" for t, g, p in K.FAMILY_GROUPS)
_residues = ", ".join(
    f"('{c}', '{n}', '{s}', '{k}', {str(own).lower()})" for c, n, s, k, own in K.AMINO_ACIDS
)
_phases = " ".join(f"WHEN '{stage}' THEN {phase}" for stage, phase in K.STAGE_PHASE.items())

STAR_SQL = {
    **B.SQL,
    "seed_family": f"SELECT * FROM (VALUES {_families}) v(label, family, priority)",
    "seed_residue": f"SELECT * FROM (VALUES {_residues}) v(code, name, short, category, own)",
    "targets": """
        SELECT id AS gene, [p.id FOR p IN proteinIds IF p.source = 'uniprot_swissprot'][1] AS acc
        FROM b_ot_targets""",
    "best_family": """
        SELECT acc, family FROM (
            SELECT c.acc, s.family,
                   row_number() OVER (PARTITION BY c.acc ORDER BY s.priority, s.family) AS rn
            FROM (SELECT uniprot_accession AS acc, trim(unnest(string_split(protein_class, ','))) AS label
                  FROM b_hpa WHERE uniprot_accession IS NOT NULL AND protein_class <> '') c
            JOIN seed_family s USING (label)) WHERE rn = 1""",
    "protein": """
        SELECT u.primary_accession AS acc, u.gene_symbol, u.protein_name, u.sequence_length, u.sequence,
               u.pfam_ids[1] AS pfam_id,
               coalesce(u.function_raw, 'No information available') AS function_raw,
               coalesce(e.function_friendly, r.function_friendly, u.function_raw,
                        'No information available') AS function_friendly,
               coalesce(e.tagline, r.tagline, 'No information available') AS tagline,
               e.uniprot_accession IS NOT NULL AS is_curated,
               u.ensembl_gene_ids[1] AS ensembl_gene_id, u.string_ids[1] AS string_protein_id,
               h.protein_class, h.subcellular_location,
               coalesce(f.family, 'Unclassified') AS family_group
        FROM b_uniprot u
        LEFT JOIN b_hpa h ON h.uniprot_accession = u.primary_accession
        LEFT JOIN b_editorial e ON e.uniprot_accession = u.primary_accession
        LEFT JOIN b_llm_rewrites r ON r.uniprot_accession = u.primary_accession
        LEFT JOIN best_family f ON f.acc = u.primary_accession""",
    "disease": "SELECT id AS efo_id, name AS disease_name FROM b_ot_diseases WHERE name IS NOT NULL",
    "drug": f"""
        SELECT p.chembl_id, m.name AS drug_name, p.max_phase, m.drugType AS modality
        FROM (SELECT drugId AS chembl_id, max(CASE maxClinicalStage {_phases} END)::SMALLINT AS max_phase
              FROM b_ot_drugs GROUP BY drugId) p
        LEFT JOIN b_ot_drug_molecules m ON m.id = p.chembl_id""",
    "pair": """
        SELECT least(uniprot_a, uniprot_b) AS a, greatest(uniprot_a, uniprot_b) AS b,
               max(combined_score) AS score
        FROM b_string
        WHERE uniprot_a <> uniprot_b
          AND uniprot_a IN (SELECT acc FROM protein) AND uniprot_b IN (SELECT acc FROM protein)
        GROUP BY ALL""",
    "evidence": """
        SELECT t.acc, x.diseaseId AS efo_id, max(CAST(x.associationScore AS DECIMAL(10, 6))) AS score
        FROM b_ot_associations x JOIN targets t ON t.gene = x.targetId
        WHERE t.acc IN (SELECT acc FROM protein) AND x.diseaseId IN (SELECT efo_id FROM disease)
        GROUP BY ALL HAVING max(CAST(x.associationScore AS DECIMAL(10, 6))) >= 0.1""",
    "triple": """
        SELECT DISTINCT d.drugId AS chembl_id, t.acc, d.efo_id
        FROM (SELECT drugId, targetId, unnest(diseases) AS efo_id FROM b_ot_drugs) d
        JOIN targets t ON t.gene = d.targetId
        WHERE t.acc IN (SELECT acc FROM protein) AND d.drugId IN (SELECT chembl_id FROM drug)""",
    "letters": """
        SELECT p.acc, r.code, length(p.sequence) - length(replace(p.sequence, r.code, '')) AS n,
               floor(CAST(length(p.sequence) - length(replace(p.sequence, r.code, '')) AS DOUBLE)
                     * CAST(100 AS DOUBLE) / CAST(p.sequence_length AS DOUBLE) * CAST(100 AS DOUBLE)
                     + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) AS pct
        FROM protein p, seed_residue r WHERE length(p.sequence) > 0""",
    "partner": """
        SELECT s.acc, s.other, p.gene_symbol, p.protein_name, s.score,
               row_number() OVER (PARTITION BY s.acc ORDER BY s.score DESC, s.other) AS rank
        FROM (SELECT a AS acc, b AS other, score FROM pair
              UNION ALL SELECT b, a, score FROM pair) s
        JOIN protein p ON p.acc = s.other
        QUALIFY rank <= 20""",
    "top_disease": """
        SELECT e.acc, e.efo_id, d.disease_name, e.score,
               row_number() OVER (PARTITION BY e.acc ORDER BY e.score DESC, e.efo_id) AS rank
        FROM evidence e JOIN disease d USING (efo_id)
        QUALIFY rank <= 5""",
    "top_drug": """
        SELECT x.acc, d.chembl_id, d.drug_name, d.max_phase,
               row_number() OVER (PARTITION BY x.acc ORDER BY d.max_phase DESC, d.chembl_id) AS rank
        FROM (SELECT DISTINCT acc, chembl_id FROM triple) x JOIN drug d USING (chembl_id)
        WHERE d.max_phase >= 3
        QUALIFY rank <= 5""",
}


def sql(final: str) -> str:
    return with_ctes(STAR_SQL, final)


# --- staging ------------------------------------------------------------------------------


@query(
    "P1 S10",
    sql("""SELECT primary_accession AS uniprot_accession, gene_symbol, protein_name, sequence_length,
                  md5(sequence) AS sequence_md5, function_raw, pfam_ids[1] AS pfam_id,
                  ensembl_gene_ids[1] AS ensembl_gene_id, string_ids[1] AS string_protein_id
           FROM b_uniprot"""),
)
def stg_uniprot(spark: SparkSession, sf: str) -> DataFrame:
    staged = star(spark, sf)["stg_uniprot"]
    return staged.withColumn("sequence_md5", F.md5("sequence")).drop("sequence")


@query("P2", sql("SELECT * FROM b_hpa WHERE uniprot_accession IS NOT NULL"))
def stg_hpa(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["stg_hpa"]


@query("P3", sql("SELECT * FROM b_string"))
def stg_string(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["stg_string"]


@query(
    "P4 F3",
    sql("""SELECT id AS ensembl_gene_id, approvedSymbol AS gene_symbol, approvedName AS gene_name,
                  t.acc AS uniprot_accession
           FROM b_ot_targets JOIN targets t ON t.gene = id"""),
)
def stg_ot_targets(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["stg_ot_targets"]


@query("P5", sql("SELECT efo_id, disease_name FROM disease"))
def stg_ot_diseases(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["stg_ot_diseases"]


@query(
    "P6",
    sql("""SELECT targetId AS ensembl_gene_id, diseaseId AS efo_id,
                  CAST(CAST(associationScore AS DECIMAL(10, 6)) AS DOUBLE) + 0 AS overall_score
           FROM b_ot_associations"""),
)
def stg_ot_associations(spark: SparkSession, sf: str) -> DataFrame:
    staged = star(spark, sf)["stg_ot_associations"]
    return staged.withColumn("overall_score", F.col("overall_score").cast("double"))


@query(
    "P7 S10",
    sql("""SELECT drugId AS chembl_id, targetId AS ensembl_gene_id,
                  array_to_string([coalesce(d, '-') FOR d IN diseases], '|') AS disease_ids,
                  maxClinicalStage AS max_clinical_stage_raw
           FROM b_ot_drugs"""),
)
def stg_ot_drugs(spark: SparkSession, sf: str) -> DataFrame:
    ids = F.transform("disease_ids", lambda d: F.coalesce(d["diseaseId"], F.lit("-")))
    return star(spark, sf)["stg_ot_drugs"].withColumn("disease_ids", F.array_join(ids, "|"))


@query(
    "P8",
    sql("""SELECT id AS chembl_id, name AS drug_name, drugType AS modality
           FROM b_ot_drug_molecules WHERE id IS NOT NULL"""),
)
def stg_ot_drug_molecules(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["stg_ot_drug_molecules"]


@query("P9", sql("SELECT * FROM b_llm_rewrites"))
def stg_llm_rewrites(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["stg_llm_rewrites"]


# --- dimensions and facts -------------------------------------------------------------------


@query(
    "Q1 P13 P14 P15 P16 X2 A4 J3 J9",
    sql("""SELECT acc AS uniprot_accession, gene_symbol, protein_name, sequence_length,
                  md5(sequence) AS sequence_md5, pfam_id, function_raw, function_friendly, tagline,
                  is_curated, ensembl_gene_id, string_protein_id,
                  CAST(NULL AS VARCHAR) AS chembl_target_id, protein_class, subcellular_location,
                  family_group
           FROM protein"""),
)
def dim_protein(spark: SparkSession, sf: str) -> DataFrame:
    dim = star(spark, sf)["dim_protein"]
    return dim.withColumn("sequence_md5", F.md5("sequence")).drop("sequence", "updated_at")


@query("Q2 P16", sql("SELECT *, CAST(NULL AS VARCHAR) AS therapeutic_area FROM disease"))
def dim_disease(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["dim_disease"]


@query("Q3 P12 A3 J4", sql("SELECT * FROM drug"))
def dim_drug(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["dim_drug"]


@query(
    "Q4 J1",
    sql("""SELECT uniprot_accession, rna_tissue_specificity AS tissue,
                  rna_tissue_distribution AS expression_level
           FROM b_hpa WHERE uniprot_accession IN (SELECT acc FROM protein)"""),
)
def fact_protein_tissue(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["fact_protein_tissue"]


@query(
    "Q5 J2 P11 X13 A1",
    sql("SELECT a AS uniprot_a, b AS uniprot_b, score AS combined_score FROM pair"),
)
def fact_interaction(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["fact_interaction"]


@query(
    "Q6 J1 J5 A2",
    sql("SELECT acc AS uniprot_accession, efo_id, CAST(score AS DOUBLE) AS overall_score FROM evidence"),
)
def fact_protein_disease(spark: SparkSession, sf: str) -> DataFrame:
    fact = star(spark, sf)["fact_protein_disease"]
    return fact.withColumn("overall_score", F.col("overall_score").cast("double"))


@query(
    "Q7 X4 J5 J1 A7",
    sql("""SELECT chembl_id, acc AS uniprot_accession, efo_id,
                  CAST(NULL AS VARCHAR) AS mechanism_of_action FROM triple"""),
)
def fact_drug_target_disease(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["fact_drug_target_disease"]


@query(
    "Q8 X1 J9",
    sql("""SELECT acc AS uniprot_accession, code AS amino_acid_code, n AS count, pct AS pct_of_sequence
           FROM letters"""),
)
def fact_protein_aa_composition(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)["fact_protein_aa_composition"]


# --- cards --------------------------------------------------------------------------------


@query(
    "Q9 J3",
    sql("""SELECT p.acc AS uniprot_accession, p.gene_symbol, p.protein_name, p.sequence_length,
                  md5(p.sequence) AS sequence_md5, p.pfam_id, p.function_raw, p.function_friendly,
                  p.tagline, p.is_curated, p.protein_class, p.subcellular_location, p.family_group,
                  h.rna_tissue_specificity AS tissue_specificity,
                  h.rna_tissue_distribution AS tissue_distribution,
                  coalesce(i.n, 0)::INTEGER AS n_partners, coalesce(d.n, 0)::INTEGER AS n_diseases,
                  coalesce(g.n, 0)::INTEGER AS n_drugs
           FROM protein p LEFT JOIN b_hpa h ON h.uniprot_accession = p.acc
           LEFT JOIN (SELECT acc, count(*) AS n FROM partner GROUP BY acc) i ON i.acc = p.acc
           LEFT JOIN (SELECT acc, count(*) AS n FROM top_disease GROUP BY acc) d ON d.acc = p.acc
           LEFT JOIN (SELECT acc, count(*) AS n FROM top_drug GROUP BY acc) g ON g.acc = p.acc"""),
)
def story_cards(spark: SparkSession, sf: str) -> DataFrame:
    card = cards.story_cards(served(spark, sf))
    return card.select(
        *(c for c in card.columns if c not in ("sequence", cards.PARTNERS, cards.DISEASES, cards.DRUGS)),
        F.md5("sequence").alias("sequence_md5"),
        F.size(cards.PARTNERS).alias("n_partners"),
        F.size(cards.DISEASES).alias("n_diseases"),
        F.size(cards.DRUGS).alias("n_drugs"),
    )


@query(
    "Q9 J7 J8 W2 A8 X10",
    sql("""SELECT acc AS uniprot_accession, rank::INTEGER AS rank, other AS accession, gene_symbol,
                  protein_name, round(CAST(score AS DOUBLE) / 1000, 3) AS combined_score
           FROM partner"""),
)
def story_card_partners(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_list(cards.story_cards(served(spark, sf)), ANCHOR, cards.PARTNERS)


@query(
    "Q9 J8 W2 A8 X10",
    sql("""SELECT acc AS uniprot_accession, rank::INTEGER AS rank, efo_id, disease_name,
                  CAST(round(score, 3) AS DOUBLE) AS overall_score
           FROM top_disease"""),
)
def story_card_diseases(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_list(cards.story_cards(served(spark, sf)), ANCHOR, cards.DISEASES)


@query(
    "Q9 J8 W2 A8",
    sql("""SELECT acc AS uniprot_accession, rank::INTEGER AS rank, chembl_id, drug_name, max_phase
           FROM top_drug"""),
)
def story_card_drugs(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_list(cards.story_cards(served(spark, sf)), ANCHOR, cards.DRUGS)


@query(
    "P18 P19 Q9",
    sql("""SELECT p.acc AS uniprot_accession, p.tagline, count(i.acc)::INTEGER AS n_partners
           FROM protein p LEFT JOIN partner i ON i.acc = p.acc
           WHERE p.acc IN (SELECT uniprot_accession FROM b_editorial)
           GROUP BY p.acc, p.tagline"""),
)
def story_cards_of_curated(spark: SparkSession, sf: str) -> DataFrame:
    """The batch form of the point lookup: cards of a key relation."""
    keys = B.editorial(spark, sf).select(ANCHOR)
    card = cards.story_cards(served(spark, sf), keys)
    return card.select(ANCHOR, "tagline", F.size(cards.PARTNERS).alias("n_partners"))


THRESHOLD = 0.9


@query(
    "A13 P23",
    sql(f"""SELECT p.acc AS uniprot_accession,
                   (coalesce(i.n, 0) + coalesce(d.n, 0) + coalesce(g.n, 0))::INTEGER AS connected_entities,
                   coalesce(d.n, 0)::INTEGER AS linked_diseases,
                   coalesce(g.n, 0)::INTEGER AS targeted_drugs
            FROM protein p
            LEFT JOIN (SELECT acc, count(*) AS n FROM partner
                       WHERE round(CAST(score AS DOUBLE) / 1000, 3) >= {THRESHOLD} GROUP BY acc) i ON i.acc = p.acc
            LEFT JOIN (SELECT acc, count(*) AS n FROM top_disease
                       WHERE CAST(round(score, 3) AS DOUBLE) >= {THRESHOLD} GROUP BY acc) d ON d.acc = p.acc
            LEFT JOIN (SELECT acc, count(*) AS n FROM top_drug GROUP BY acc) g ON g.acc = p.acc"""),
)
def card_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return cards.card_kpis(cards.story_cards(served(spark, sf)), THRESHOLD)


EGO_THRESHOLD = 0.15


@query(
    "Q14 O4 P23 X11 X12 U1",
    sql(f"""SELECT acc AS uniprot_accession, 'partner' AS entity_type, other AS id,
                   coalesce(gene_symbol, other) AS label,
                   'confidence ' || CAST(round_even(round(CAST(score AS DOUBLE) / 1000, 3) * 100, 0) AS INTEGER)
                   || '%' AS detail,
                   round(CAST(score AS DOUBLE) / 1000, 3) AS strength
            FROM partner WHERE round(CAST(score AS DOUBLE) / 1000, 3) >= {EGO_THRESHOLD}
            UNION ALL
            SELECT acc, 'disease', efo_id, disease_name,
                   'evidence ' || CAST(round_even(CAST(round(score, 3) AS DOUBLE) * 100, 0) AS INTEGER) || '%',
                   CAST(round(score, 3) AS DOUBLE)
            FROM top_disease WHERE CAST(round(score, 3) AS DOUBLE) >= {EGO_THRESHOLD}
            UNION ALL
            SELECT acc, 'drug', chembl_id, coalesce(drug_name, chembl_id),
                   CASE WHEN max_phase = 4 THEN 'Approved' WHEN max_phase = 3 THEN 'Late-stage trials'
                        WHEN max_phase IS NULL THEN 'In development' ELSE 'Phase ' || max_phase END,
                   least(1.0, coalesce(max_phase, 0) / 4.0)::DOUBLE
            FROM top_drug"""),
)
def ego_edges(spark: SparkSession, sf: str) -> DataFrame:
    return cards.ego_edges(cards.story_cards(served(spark, sf)), EGO_THRESHOLD)


# --- lookups ------------------------------------------------------------------------------


@query(
    "S16 X12",
    sql("""SELECT acc AS uniprot_accession, gene_symbol, protein_name,
                  CASE WHEN gene_symbol IS NULL THEN acc
                       ELSE gene_symbol || ' (' || protein_name || ')' END AS label
           FROM protein"""),
)
def list_proteins(spark: SparkSession, sf: str) -> DataFrame:
    return cards.with_labels(lookup.list_proteins(served(spark, sf)["dim_protein"]))


_SEARCH = """
    SELECT acc AS uniprot_accession, gene_symbol, protein_name FROM protein
    WHERE coalesce(gene_symbol, '') ILIKE '%{q}%' OR protein_name ILIKE '%{q}%' OR acc ILIKE '%{q}%'
    ORDER BY CASE WHEN coalesce(gene_symbol, '') ILIKE '{q}%' OR protein_name ILIKE '{q}%' OR acc ILIKE '{q}%'
                  THEN 0 ELSE 1 END, length(protein_name), acc
    LIMIT 20"""


@query("Q10 P17 O2", sql(_SEARCH.format(q="RING")))
def search_symbol(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.search(served(spark, sf)["dim_protein"], "RING")


@query("Q10 P17 O2", sql(_SEARCH.format(q="w_d%et")))
def search_wildcard(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.search(served(spark, sf)["dim_protein"], "w_d%et")


@query(
    "Q11 J10 A5 A6 S15",
    sql("""SELECT p.acc AS uniprot_accession, p.gene_symbol, p.family_group, e.umap_x, e.umap_y,
                  coalesce(d.n, 0) AS disease_count, coalesce(g.n, 0) AS drug_count
           FROM protein p JOIN b_embedding e ON e.uniprot_accession = p.acc
           LEFT JOIN (SELECT acc, count(*) AS n FROM evidence GROUP BY acc) d ON d.acc = p.acc
           LEFT JOIN (SELECT t.acc, count(DISTINCT chembl_id) AS n FROM triple t
                      JOIN drug USING (chembl_id) WHERE max_phase >= 3 GROUP BY t.acc) g ON g.acc = p.acc"""),
)
def map_extract(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.map_extract(served(spark, sf))


@query(
    "S15",
    sql("""SELECT count(*) AS points, min(e.umap_x) AS min_x, max(e.umap_x) AS max_x,
                  min(e.umap_y) AS min_y, max(e.umap_y) AS max_y
           FROM protein JOIN b_embedding e ON e.uniprot_accession = acc"""),
)
def map_extract_file(spark: SparkSession, sf: str) -> DataFrame:
    """The extract as a columnar file, which is what a map reads."""
    path = scratch_path(spark, "map")
    write_parquet(lookup.map_extract(served(spark, sf)), path)
    return read_parquet(spark, path).agg(
        F.count(F.lit(1)).alias("points"),
        F.min("umap_x").alias("min_x"),
        F.max("umap_x").alias("max_x"),
        F.min("umap_y").alias("min_y"),
        F.max("umap_y").alias("max_y"),
    )


@query(
    "P22",
    sql("""SELECT CASE WHEN family_group IN ('Receptors', 'Enzymes') THEN family_group
                       ELSE 'Unclassified' END AS family_group, count(*) AS points
           FROM protein JOIN b_embedding e ON e.uniprot_accession = acc GROUP BY 1"""),
)
def map_groups(spark: SparkSession, sf: str) -> DataFrame:
    points = lookup.map_extract(served(spark, sf))
    folded = lookup.fold_groups(points, ["Receptors", "Enzymes"])
    return folded.groupBy("family_group").agg(F.count(F.lit(1)).alias("points"))


@query(
    "P21 A9",
    """WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y
                  FROM embeddings),
            e AS (SELECT (max(x) - min(x)) * 0.15::DOUBLE AS w, (max(y) - min(y)) * 0.15::DOUBLE AS h FROM p),
            c AS (SELECT x AS cx, y AS cy FROM p WHERE vec_id = 0)
       SELECT vec_id, x, y FROM p, e, c
       WHERE x BETWEEN cx - w AND cx + w AND y BETWEEN cy - h AND cy + h""",
)
def box_window(spark: SparkSession, sf: str) -> DataFrame:
    points = B.table(spark, sf, "embeddings").select(
        "vec_id",
        F.get("embedding", F.lit(0)).cast("double").alias("x"),
        F.get("embedding", F.lit(1)).cast("double").alias("y"),
    )
    return lookup.box_around(points, "vec_id", 0, "x", "y", fraction=0.15)


@query(
    "Q12 J9 O1",
    sql("""SELECT acc AS uniprot_accession, code AS amino_acid_code, r.name,
                  short AS three_letter_code, category, own AS produced_by_body, n AS count,
                  pct AS pct_of_sequence
           FROM letters JOIN seed_residue r USING (code)"""),
)
def composition_lookup(spark: SparkSession, sf: str) -> DataFrame:
    tables = served(spark, sf)
    found = lookup.composition(tables["fact_protein_aa_composition"], tables["seed_amino_acids"])
    return found.drop("description", "deficiency_note")


@query(
    "A12 W3 O1",
    sql("""SELECT acc AS uniprot_accession, category, share AS pct_of_sequence,
                  round(CASE WHEN big = 0 THEN 0 ELSE share / big * 100 END, 6) AS bar_pct
           FROM (SELECT *, max(share) OVER (PARTITION BY acc) AS big
                 FROM (SELECT acc, category, round(sum(pct), 2) AS share
                       FROM letters JOIN seed_residue USING (code) GROUP BY ALL))"""),
)
def composition_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rolled = category_rollup(served(spark, sf)["fact_protein_aa_composition"], amino_acids(spark), ANCHOR)
    rounded = rolled.withColumn("pct_of_sequence", F.round("pct_of_sequence", 2))
    barred = with_bar(rounded, ANCHOR, "pct_of_sequence")
    return barred.withColumn("bar_pct", F.round("bar_pct", 6))


@query(
    "P18",
    sql("""SELECT acc AS uniprot_accession, sequence_length FROM protein
           WHERE acc IN (SELECT uniprot_accession FROM b_editorial)"""),
)
def sequence_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.lengths(served(spark, sf)["dim_protein"], B.editorial(spark, sf).select(ANCHOR))


# Mart -> the relation of the SQL above with the same rows.
_CONTRACT = {
    "dim_protein": "protein",
    "dim_disease": "disease",
    "dim_drug": "drug",
    "fact_interaction": "pair",
    "fact_protein_partner": "(SELECT a FROM pair UNION ALL SELECT b FROM pair)",
    "fact_protein_disease": "evidence",
    "fact_drug_target_disease": "triple",
}


@query(
    "D16 S13",
    sql(" UNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS found_rows, 0 AS differences, 0::BIGINT AS rows_without_data, "
        f"0 AS differences_without_data FROM {relation}"
        for mart, relation in _CONTRACT.items()
    )),
)
def schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Declared against found columns and types of the written marts, with data and without."""
    full = served(spark, sf)
    none = build_star(spark, empty_sources(spark), B.editorial(spark, sf).limit(0))
    found = []
    for mart in _CONTRACT:
        for tables, kind in ((full, "found"), (none, "without")):
            written = tables[mart] if tables is full else stash(tables[mart], mart)
            differences = len(schema_differences(written, schemas.MARTS[mart]))
            found.append(written.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(mart).alias("mart"), F.lit(kind).alias("kind"), "n", F.lit(differences).alias("d")
            ))
    union = found[0]
    for one in found[1:]:
        union = union.unionByName(one)

    def of(kind: str, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    return union.groupBy("mart").agg(
        of("found", "n").alias("found_rows"),
        of("found", "d").alias("differences"),
        of("without", "n").alias("rows_without_data"),
        of("without", "d").alias("differences_without_data"),
    )


TEXT_BUCKETS = 64
_text_indexes: dict[tuple[str, str], str] = {}


def text_index(spark: SparkSession, sf: str) -> str:
    """Where the postings of the served proteins are, written on first use."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _text_indexes:
        path = scratch_path(spark, "postings")
        write_text_index(served(spark, sf)["dim_protein"], path, TEXT_BUCKETS)
        _text_indexes[at] = path
    return _text_indexes[at]


@query("Q10 P17 O2", sql(_SEARCH.format(q="Dget")))
def search_by_index(spark: SparkSession, sf: str) -> DataFrame:
    dim = served(spark, sf)["dim_protein"]
    return search_indexed(dim, text_index(spark, sf), "Dget", TEXT_BUCKETS)


@query("Q10 P17 O2", sql(_SEARCH.format(q="red%gear")))
def search_by_index_wildcard(spark: SparkSession, sf: str) -> DataFrame:
    """Trigrams of both runs; the order of the runs is left to the search."""
    dim = served(spark, sf)["dim_protein"]
    return search_indexed(dim, text_index(spark, sf), "red%gear", TEXT_BUCKETS)
