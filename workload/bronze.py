"""The nine bronze relations and the editorial seed, derived from the driver tables.

Parts are proteins (with the document of the same number as sequence), lines are edges,
associations and drug records, customers are diseases, suppliers are drugs. Every driver row
becomes a bronze row, except orders that no line belongs to: they would be diseases without
evidence. ``SQL`` states the same derivation for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.plans.tables import Tables
from keystar.sources.readers import spread
from workload.registry import table


def _id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def uniprot(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread(table(spark, sf, "documents").select("doc_id", "text", "n_chars"), spark.sparkContext.defaultParallelism)
    none = F.array().cast("array<string>")
    return (
        table(spark, sf, "part")
        .join(documents, F.col("p_partkey") == F.col("doc_id"), "left")
        .select(
            _id("P", "p_partkey").alias("primary_accession"),
            F.array("p_brand").alias("secondary_accessions"),
            F.when(
                F.col("p_type") != "PROMO",
                F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.col("p_size").cast("string")),
            ).alias("gene_symbol"),
            F.col("p_name").alias("protein_name"),
            F.col("n_chars").alias("sequence_length"),
            F.col("text").alias("sequence"),
            F.when(F.col("p_type") != "ECONOMY", F.concat_ws(" ", "p_type", "p_brand")).alias(
                "function_raw"
            ),
            F.array("p_type", "p_brand").alias("keywords"),
            F.when(F.col("p_size") > 25, F.array("p_brand", "p_type")).otherwise(none).alias("pfam_ids"),
            F.array(_id("G", "p_partkey")).alias("ensembl_gene_ids"),
            F.array(_id("9606.E", "p_partkey")).alias("string_ids"),
        )
    )


def string(spark: SparkSession, sf: str) -> DataFrame:
    end = F.when(F.col("l_linenumber") == 7, F.lit("X")).otherwise(F.lit("P"))
    return table(spark, sf, "lineitem").select(
        _id("P", "l_partkey").alias("uniprot_a"),
        F.concat(end, F.col("l_suppkey").cast("string")).alias("uniprot_b"),
        (F.col("l_quantity") * 6 + 700).cast("int").alias("combined_score"),
    )


def hpa(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("p_type")
    classes = (
        F.when(kind == "STANDARD", "Enzymes, Predicted intracellular proteins")
        .when(kind == "PROMO", "Predicted membrane proteins, G-protein coupled receptors")
        .when(kind == "SMALL", "Transporters,Plasma proteins")
        .when(kind == "MEDIUM", "Plasma proteins")
        .when(kind == "ECONOMY", "")
    )
    return table(spark, sf, "part").select(
        F.when(F.col("p_size") != 7, _id("P", "p_partkey")).alias("uniprot_accession"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("gene_symbol"),
        classes.alias("protein_class"),
        F.col("p_brand").alias("rna_tissue_specificity"),
        F.col("p_type").alias("rna_tissue_distribution"),
        F.col("p_name").alias("subcellular_location"),
        F.lit(None).cast("string").alias("disease_involvement"),
    )


def ot_targets(spark: SparkSession, sf: str) -> DataFrame:
    def protein(source: str, id: Column) -> Column:
        return F.struct(F.lit(source).alias("source"), id.alias("id"))

    other = protein("uniprot_trembl", _id("T", "p_partkey"))
    copy_of = F.concat(F.lit("P"), (F.col("p_partkey") - F.col("p_partkey") % 5).cast("string"))
    return table(spark, sf, "part").select(
        _id("G", "p_partkey").alias("id"),
        F.col("p_brand").alias("approvedSymbol"),
        F.col("p_name").alias("approvedName"),
        F.when(F.col("p_size") > 45, F.lit(None))
        .when(F.col("p_size") > 40, F.array(other))
        .otherwise(F.array(other, protein(K.SWISSPROT, copy_of)))
        .alias("proteinIds"),
    )


def ot_diseases(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        _id("EFO_", "c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("name"),
    )


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_discount", "l_returnflag"
    )
    return spread(lines, spark.sparkContext.defaultParallelism).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def ot_associations(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select(
        _id("EFO_", "o_custkey").alias("diseaseId"),
        _id("G", "l_partkey").alias("targetId"),
        (F.col("l_discount") * 2).alias("associationScore"),
    )


def ot_drugs(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")

    def disease(id: Column) -> Column:
        return F.struct(
            F.col("o_orderpriority").alias("diseaseFromSource"), id.alias("diseaseId")
        )

    known, unknown = disease(_id("EFO_", "o_custkey")), disease(F.lit(None).cast("string"))
    balance = F.col("s_acctbal")
    stage = (
        F.when(balance < 1000, "UNKNOWN")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "UNKNOWN")
        .when(balance < 3000, "PHASE_1_2")
        .when(balance < 5000, "PHASE_2_3")
        .when(balance < 7000, "PHASE_3")
        .otherwise("APPROVAL")
    )
    return (
        _lines(spark, sf)
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            _id("CHEMBL", "l_suppkey").alias("drugId"),
            _id("G", "l_partkey").alias("targetId"),
            F.when(F.col("l_returnflag") == "N", F.lit(None))
            .when(F.col("l_returnflag") == "R", F.array(unknown, known))
            .otherwise(F.array(known))
            .alias("diseases"),
            stage.alias("maxClinicalStage"),
        )
    )


def ot_drug_molecules(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.when(F.col("s_nationkey") > 4, _id("CHEMBL", "s_suppkey")).alias("id"),
        F.col("s_name").alias("name"),
        _id("Type ", "s_nationkey").alias("drugType"),
    )


def llm_rewrites(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        _id("P", "p_partkey").alias("uniprot_accession"),
        F.when(F.col("p_size") < 20, F.concat(F.lit("About "), F.col("p_name"))).alias(
            "function_friendly"
        ),
        F.when(F.col("p_size") < 30, F.concat(F.col("p_brand"), F.lit(" line"))).alias("tagline"),
    )


def editorial(spark: SparkSession, sf: str) -> DataFrame:
    broken = F.replace("text", F.lit(", "), F.lit(K.REPLACEMENT_CHAR))
    return table(spark, sf, "benchmark").select(
        _id("P", "item_id").alias("uniprot_accession"),
        broken.alias("tagline"),
        F.when(F.length("text") < 300, broken).alias("function_friendly"),
        F.lit(True).alias("is_curated"),
    )


def fact_embedding(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as proteins, two of their components as coordinates."""
    return table(spark, sf, "embeddings").select(
        _id("P", "vec_id").alias("uniprot_accession"),
        "embedding",
        F.get("embedding", F.lit(0)).alias("umap_x"),
        F.get("embedding", F.lit(1)).alias("umap_y"),
    )


BRONZE = {
    "uniprot": uniprot,
    "string": string,
    "hpa": hpa,
    "ot_targets": ot_targets,
    "ot_diseases": ot_diseases,
    "ot_associations": ot_associations,
    "ot_drugs": ot_drugs,
    "ot_drug_molecules": ot_drug_molecules,
    "llm_rewrites": llm_rewrites,
}


def bronze(spark: SparkSession, sf: str) -> Tables:
    return Tables({name: (lambda derive=derive: derive(spark, sf)) for name, derive in BRONZE.items()})


SQL = {
    "b_uniprot": """
        SELECT 'P' || p_partkey AS primary_accession, [p_brand] AS secondary_accessions,
               CASE WHEN p_type <> 'PROMO' THEN split_part(p_name, ' ', 2) || p_size END AS gene_symbol,
               p_name AS protein_name, n_chars AS sequence_length, text AS sequence,
               CASE WHEN p_type <> 'ECONOMY' THEN p_type || ' ' || p_brand END AS function_raw,
               [p_type, p_brand] AS keywords,
               CASE WHEN p_size > 25 THEN [p_brand, p_type] ELSE [] END AS pfam_ids,
               ['G' || p_partkey] AS ensembl_gene_ids, ['9606.E' || p_partkey] AS string_ids
        FROM part LEFT JOIN documents ON doc_id = p_partkey""",
    "b_string": """
        SELECT 'P' || l_partkey AS uniprot_a,
               (CASE WHEN l_linenumber = 7 THEN 'X' ELSE 'P' END) || l_suppkey AS uniprot_b,
               CAST(l_quantity * 6 + 700 AS INTEGER) AS combined_score
        FROM lineitem""",
    "b_hpa": """
        SELECT CASE WHEN p_size <> 7 THEN 'P' || p_partkey END AS uniprot_accession,
               split_part(p_name, ' ', 2) AS gene_symbol,
               CASE p_type
                    WHEN 'STANDARD' THEN 'Enzymes, Predicted intracellular proteins'
                    WHEN 'PROMO' THEN 'Predicted membrane proteins, G-protein coupled receptors'
                    WHEN 'SMALL' THEN 'Transporters,Plasma proteins'
                    WHEN 'MEDIUM' THEN 'Plasma proteins'
                    WHEN 'ECONOMY' THEN '' END AS protein_class,
               p_brand AS rna_tissue_specificity, p_type AS rna_tissue_distribution,
               p_name AS subcellular_location, CAST(NULL AS VARCHAR) AS disease_involvement
        FROM part""",
    "b_ot_targets": """
        SELECT 'G' || p_partkey AS id, p_brand AS approvedSymbol, p_name AS approvedName,
               CASE WHEN p_size > 45 THEN NULL
                    WHEN p_size > 40 THEN [{'source': 'uniprot_trembl', 'id': 'T' || p_partkey}]
                    ELSE [{'source': 'uniprot_trembl', 'id': 'T' || p_partkey},
                          {'source': 'uniprot_swissprot', 'id': 'P' || (p_partkey - p_partkey % 5)}]
               END AS proteinIds
        FROM part""",
    "b_ot_diseases": """
        SELECT 'EFO_' || c_custkey AS id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS name
        FROM customer""",
    "b_lines": "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "b_ot_associations": """
        SELECT 'EFO_' || o_custkey AS diseaseId, 'G' || l_partkey AS targetId,
               l_discount * 2 AS associationScore
        FROM b_lines""",
    "b_ot_drugs": """
        SELECT 'CHEMBL' || l_suppkey AS drugId, 'G' || l_partkey AS targetId,
               CASE l_returnflag
                    WHEN 'N' THEN NULL
                    WHEN 'R' THEN [CAST(NULL AS VARCHAR), 'EFO_' || o_custkey]
                    ELSE ['EFO_' || o_custkey] END AS diseases,
               CASE WHEN s_acctbal < 1000 THEN 'UNKNOWN'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'UNKNOWN'
                    WHEN s_acctbal < 3000 THEN 'PHASE_1_2'
                    WHEN s_acctbal < 5000 THEN 'PHASE_2_3'
                    WHEN s_acctbal < 7000 THEN 'PHASE_3'
                    ELSE 'APPROVAL' END AS maxClinicalStage
        FROM b_lines JOIN supplier ON s_suppkey = l_suppkey""",
    "b_ot_drug_molecules": """
        SELECT CASE WHEN s_nationkey > 4 THEN 'CHEMBL' || s_suppkey END AS id,
               s_name AS name, 'Type ' || s_nationkey AS drugType
        FROM supplier""",
    "b_llm_rewrites": """
        SELECT 'P' || p_partkey AS uniprot_accession,
               CASE WHEN p_size < 20 THEN 'About ' || p_name END AS function_friendly,
               CASE WHEN p_size < 30 THEN p_brand || ' line' END AS tagline
        FROM part""",
    "b_editorial": """
        SELECT 'P' || item_id AS uniprot_accession, replace(text, ', ', chr(8212)) AS tagline,
               CASE WHEN length(text) < 300 THEN replace(text, ', ', chr(8212)) END AS function_friendly
        FROM benchmark""",
    "b_embedding": """
        SELECT 'P' || vec_id AS uniprot_accession, embedding,
               embedding[1] AS umap_x, embedding[2] AS umap_y
        FROM embeddings""",
}
