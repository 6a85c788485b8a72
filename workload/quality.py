"""Data-quality checks on tables that violate them, and the whole check suite over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.operators import quality as Q
from keystar.operators.composition import letter_composition
from keystar.functions.texts import standard_length
from keystar.plans import checks as C
from workload.registry import query, table, with_ctes
from workload.star import STAR_SQL, served

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
_PRIORITY_LIST = ", ".join(f"'{p}'" for p in PRIORITIES)

_LETTERS = "".join(sorted(K.RESIDUES))


@query("D1", "SELECT p_partkey, doc_id FROM part LEFT JOIN documents ON doc_id = p_partkey WHERE doc_id IS NULL")
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id")
    joined = table(spark, sf, "part").select("p_partkey").join(
        documents, F.col("p_partkey") == F.col("doc_id"), "left"
    )
    return Q.not_null(joined, "doc_id")


@query(
    "D2 D10",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return Q.unique(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "D2",
    """SELECT o_custkey, count(*) AS row_count FROM orders GROUP BY 1 HAVING count(*) > 1""",
)
def dq_unique_single(spark: SparkSession, sf: str) -> DataFrame:
    return Q.unique(table(spark, sf, "orders"), "o_custkey")


@query("D3", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    return Q.relationships(
        table(spark, sf, "documents").select("doc_id"), "doc_id", table(spark, sf, "labels"), "doc_id"
    )


@query("D4 P20", f"SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ({_PRIORITY_LIST})")
def dq_accepted(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return Q.accepted_values(orders, "o_orderpriority", PRIORITIES)


@query(
    "D5 D6 D7",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount + 0.0::DOUBLE AS l_discount
       FROM lineitem WHERE l_discount < 0.01 OR l_discount > 0.09""",
)
def dq_range(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")
    return Q.in_range(lines, "l_discount", 0.01, 0.09).withColumn(
        "l_discount", F.col("l_discount") + F.lit(0.0)
    )


@query("D8", "SELECT l_partkey, l_suppkey, l_orderkey FROM lineitem WHERE l_partkey = l_suppkey")
def dq_self_pairs(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey")
    return Q.no_self_pairs(lines, "l_partkey", "l_suppkey")


@query(
    "D9 U1",
    """WITH c AS (SELECT l_partkey, l_suppkey, count(*) AS row_count FROM lineitem GROUP BY ALL)
       SELECT *, 'order' AS violation FROM c WHERE l_partkey >= l_suppkey
       UNION ALL SELECT *, 'repeat' FROM c WHERE row_count > 1""",
)
def dq_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return Q.canonical_pairs(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


@query(
    "D11 X6",
    """SELECT page_id, length(url) AS stored, length(html) AS actual_length FROM pages
       WHERE length(url) <= 0 OR length(url) <> length(html)""",
)
def dq_length(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").withColumn("stored", F.length("url").cast("long"))
    found = Q.length_matches(pages, "stored", "html")
    return found.select("page_id", "stored", F.col("actual_length").cast("long").alias("actual_length"))


@query("D12 A10", "SELECT count(*) AS row_count FROM customer HAVING count(*) < 1000000000")
def dq_volume(spark: SparkSession, sf: str) -> DataFrame:
    return Q.volume_floor(table(spark, sf, "customer"), 1_000_000_000)


@query(
    "D13 P20 U1 A10",
    f"""SELECT o_orderkey, o_orderpriority, 'unexpected_or_null_o_orderpriority' AS violation
        FROM orders WHERE o_orderpriority NOT IN ({_PRIORITY_LIST})
        UNION ALL
        SELECT NULL, NULL, 'fewer_than_9_distinct_o_orderprioritys'
        FROM orders HAVING count(DISTINCT o_orderpriority) < 9""",
)
def dq_domain(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return Q.domain_and_spread(orders, "o_orderkey", "o_orderpriority", PRIORITIES, 9)


@query(
    "D14 A11 J11 X5",
    f"""WITH c AS (SELECT doc_id, letter, length(text) - length(replace(text, letter, ''))
                             + CASE WHEN doc_id % 7 = 0 AND letter = 'A' THEN 1 ELSE 0 END AS n,
                         n_chars
                  FROM documents, (SELECT unnest(string_split('{_LETTERS}', '')) AS letter)
                  WHERE length(text) > 0 AND NOT (doc_id % 11 = 0 AND letter = 'W')),
            t AS (SELECT doc_id, count(*) AS n_rows, sum(n)::BIGINT AS total_counted,
                         round(sum(floor(n::DOUBLE * 100::DOUBLE / n_chars::DOUBLE * 100::DOUBLE + 0.5::DOUBLE)
                                   / 100::DOUBLE), 2) AS total_pct
                  FROM c GROUP BY doc_id)
       SELECT doc_id, n_rows, total_counted, total_pct,
              length(regexp_replace(text, '[^{_LETTERS}]', '', 'g'))::INTEGER AS standard_residues
       FROM t JOIN documents USING (doc_id)
       WHERE n_rows <> 20 OR total_pct > 100.5
          OR total_counted <> length(regexp_replace(text, '[^{_LETTERS}]', '', 'g'))""",
)
def dq_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh document counts one letter too many, every eleventh lacks a letter's row."""
    documents = table(spark, sf, "documents")
    counted = letter_composition(documents, "doc_id", "text", "n_chars")
    added = F.when((F.col("doc_id") % 7 == 0) & (F.col("amino_acid_code") == "A"), 1).otherwise(0)
    percent = F.floor((F.col("count") + added) * 100.0 / F.col("n_chars") * 100.0 + 0.5) / 100.0
    counted = (
        counted.join(documents.select("doc_id", "n_chars"), "doc_id")
        .where(~((F.col("doc_id") % 11 == 0) & (F.col("amino_acid_code") == "W")))
        .withColumn("pct_of_sequence", percent)
        .withColumn("count", F.col("count") + added)
    )
    expected = documents.where(F.length("text") > 0).select(
        "doc_id", standard_length(F.col("text")).alias("standard_residues")
    )
    found = Q.composition_complete(counted, expected, "doc_id", 20, K.MAX_TOTAL_PCT)
    return found.withColumn("total_pct", F.round("total_pct", 2))


@query(
    "A11 J11",
    """SELECT o_orderkey, n_lines, n_parts FROM
           (SELECT l_orderkey AS o_orderkey, count(*) AS n_lines, count(DISTINCT l_partkey) AS n_parts
            FROM lineitem GROUP BY 1) JOIN orders USING (o_orderkey)
       WHERE n_lines <> 4 OR n_lines <> n_parts""",
)
def dq_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_partkey").alias("n_parts")
    )
    orders = table(spark, sf, "orders").select("o_orderkey")
    return totals.join(orders, "o_orderkey").where("n_lines <> 4 OR n_lines <> n_parts")


@query(
    "A18",
    """SELECT (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM labels) AS right_rows,
              (SELECT count(*) FROM labels WHERE quality IS NULL) AS null_quality,
              (SELECT count(*) FROM labels WHERE toxic = 1) AS toxic_rows""",
)
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return Q.coverage(
        table(spark, sf, "documents"),
        table(spark, sf, "labels"),
        {"null_quality": F.col("quality").isNull(), "toxic_rows": F.col("toxic") == 1},
    )


# --- the suite ----------------------------------------------------------------------------

# The relations under their own names, for the generated check SQL.
_RELATIONS = {
    "stg_uniprot": "SELECT primary_accession AS uniprot_accession, sequence FROM b_uniprot",
    "stg_hpa": "SELECT * FROM b_hpa WHERE uniprot_accession IS NOT NULL",
    "stg_string": "SELECT * FROM b_string",
    "stg_ot_targets": "SELECT id AS ensembl_gene_id FROM b_ot_targets",
    "stg_ot_diseases": "SELECT * FROM disease",
    "stg_ot_associations": """SELECT targetId AS ensembl_gene_id, diseaseId AS efo_id,
                                     associationScore AS overall_score FROM b_ot_associations""",
    "stg_ot_drugs": """SELECT drugId AS chembl_id, targetId AS ensembl_gene_id,
                              maxClinicalStage AS max_clinical_stage_raw FROM b_ot_drugs""",
    "stg_ot_drug_molecules": "SELECT id AS chembl_id FROM b_ot_drug_molecules WHERE id IS NOT NULL",
    "stg_llm_rewrites": "SELECT * FROM b_llm_rewrites",
    "dim_protein": "SELECT acc AS uniprot_accession, * FROM protein",
    "dim_disease": "SELECT * FROM disease",
    "dim_drug": "SELECT * FROM drug",
    "fact_protein_tissue": """SELECT uniprot_accession FROM b_hpa
                              WHERE uniprot_accession IN (SELECT acc FROM protein)""",
    "fact_interaction": "SELECT a AS uniprot_a, b AS uniprot_b, score AS combined_score FROM pair",
    "fact_protein_disease": "SELECT acc AS uniprot_accession, efo_id, score AS overall_score FROM evidence",
    "fact_protein_aa_composition": """SELECT acc AS uniprot_accession, code AS amino_acid_code, n AS count,
                                             pct AS pct_of_sequence FROM letters""",
    "fact_drug_target_disease": "SELECT chembl_id, acc AS uniprot_accession, efo_id FROM triple",
    "dim_protein_editorial": "SELECT *, true AS is_curated FROM b_editorial",
    "seed_amino_acids": """SELECT code AS amino_acid_code, name, short AS three_letter_code, category,
                                  own AS produced_by_body, CAST(NULL AS VARCHAR) AS description
                           FROM seed_residue""",
    "family_group_map": """SELECT label AS protein_class_token, family AS family_group, priority
                           FROM seed_family""",
}


def _suite_sql() -> str:
    def count(name: str, violations: str) -> str:
        return f"SELECT '{name}' AS check_name, count(*) AS violations FROM ({violations})"

    parts = []
    for relation, columns in C.NOT_NULL.items():
        for c in columns:
            parts.append(
                count(f"not_null_{relation}_{c}", f"SELECT 1 FROM r_{relation} WHERE {c} IS NULL")
            )
    for relation, keys in C.UNIQUE.items():
        for key in keys:
            given = f"WHERE {key[0]} IS NOT NULL" if len(key) == 1 else ""
            cols = ", ".join(key)
            parts.append(
                count(
                    f"unique_{relation}_{'_'.join(key)}",
                    f"SELECT {cols} FROM r_{relation} {given} GROUP BY {cols} HAVING count(*) > 1",
                )
            )
    for child, column, parent, parent_column in C.RELATIONSHIPS:
        parts.append(
            count(
                f"relationships_{child}_{column}",
                f"SELECT 1 FROM r_{child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM r_{parent} p WHERE p.{parent_column} = c.{column})",
            )
        )
    stages = ", ".join(f"'{s}'" for s in K.STAGES)
    families = ", ".join(f"'{g}'" for g in C.FAMILY_DOMAIN)
    parts += [
        count("accepted_stages", f"SELECT 1 FROM r_stg_ot_drugs WHERE max_clinical_stage_raw NOT IN ({stages})"),
        count("drug_phase_range", "SELECT 1 FROM r_dim_drug WHERE max_phase NOT BETWEEN 0 AND 4"),
        count(
            "interaction_score_range",
            "SELECT 1 FROM r_fact_interaction WHERE combined_score NOT BETWEEN 700 AND 1000",
        ),
        count("interaction_no_self_pairs", "SELECT 1 FROM r_fact_interaction WHERE uniprot_a = uniprot_b"),
        count(
            "disease_score_range",
            "SELECT 1 FROM r_fact_protein_disease WHERE overall_score NOT BETWEEN 0.1 AND 1",
        ),
        count(
            "sequence_length_consistent",
            "SELECT 1 FROM r_dim_protein WHERE sequence_length <= 0 OR sequence_length <> length(sequence)",
        ),
        count(
            "interaction_canonical_pairs",
            """SELECT 1 FROM r_fact_interaction WHERE uniprot_a >= uniprot_b GROUP BY uniprot_a, uniprot_b
               UNION ALL SELECT 1 FROM r_fact_interaction GROUP BY uniprot_a, uniprot_b HAVING count(*) > 1""",
        ),
        count(
            "composition_complete",
            f"""SELECT 1 FROM (SELECT uniprot_accession, count(*) AS n, sum(count) AS total,
                                     sum(pct_of_sequence) AS pct
                              FROM r_fact_protein_aa_composition GROUP BY 1)
               JOIN r_dim_protein USING (uniprot_accession)
               WHERE n <> 20 OR pct > 100.5
                  OR total <> length(regexp_replace(sequence, '[^{_LETTERS}]', '', 'g'))""",
        ),
        count("protein_volume", "SELECT 1 FROM r_dim_protein HAVING count(*) < 15000"),
        count(
            "family_group_valid",
            f"""SELECT 1 FROM r_dim_protein WHERE family_group IS NULL OR family_group NOT IN ({families})
                UNION ALL SELECT 1 FROM r_dim_protein HAVING count(DISTINCT family_group) < 9""",
        ),
    ]
    relations = {f"r_{name}": body for name, body in _RELATIONS.items()}
    return with_ctes({**STAR_SQL, **relations}, " UNION ALL ".join(parts))


@query("D1 D2 D3 D4 D5 D6 D7 D8 D9 D10 D11 D12 D13 D14", _suite_sql())
def quality_suite(spark: SparkSession, sf: str) -> DataFrame:
    return Q.summarize(C.star_checks(), served(spark, sf))


@query(
    "D15",
    with_ctes(
        STAR_SQL,
        """SELECT 'sequence_length_consistent' AS check_name, count(*) AS violations FROM protein
           WHERE sequence_length <= 0 OR sequence_length <> length(sequence)
           UNION ALL SELECT 'interaction_no_self_pairs', count(*) FROM pair WHERE a = b""",
    ),
)
def quality_untagged(spark: SparkSession, sf: str) -> DataFrame:
    """Two of the checks that also make sense without real data."""
    wanted = {"sequence_length_consistent", "interaction_no_self_pairs", "protein_volume"}
    chosen = [c for c in C.star_checks() if c.name in wanted]
    return Q.summarize(Q.select_checks(chosen, exclude=[Q.REAL_DATA]), served(spark, sf))
