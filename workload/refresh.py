"""Facts brought from one version of a source to the next: the same rows as a full rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar.plans.marts import fact_interaction, fact_protein_disease
from keystar.plans.refresh import changed_rows, refresh_disease, refresh_interaction
from keystar.plans.warehouse import build_star
from keystar.session import scratch_path, stash
from keystar.sources.keyed import read_keyed, write_keyed
from workload import bronze as B
from workload.registry import query, table, with_ctes
from workload.star import STAR_SQL

BUCKETS = 32


def earlier(rows: DataFrame, name: str, score: str) -> DataFrame:
    """The version before: some rows were missing, some scored otherwise, some are gone now."""
    part = F.pmod(F.xxhash64(name), F.lit(50))
    gone = rows.where(part == 2).withColumn(score, (F.col(score) * 3).cast(rows.schema[score].dataType))
    changed = F.when(part == 0, F.col(score) / 2).otherwise(F.col(score))
    kept = rows.where(part != 1).withColumn(score, changed.cast(rows.schema[score].dataType))
    return kept.unionByName(gone)


@query(
    "S9 S10 A1 Q5",
    with_ctes(STAR_SQL, "SELECT a AS uniprot_a, b AS uniprot_b, score AS combined_score FROM pair"),
)
def interaction_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    star = build_star(spark, B.bronze(spark, sf), B.editorial(spark, sf))
    new, dim = stash(star["stg_string"], "edges"), star["stg_uniprot"].select("uniprot_accession")
    old = stash(earlier(new, "uniprot_a", "combined_score"), "edges")
    path = scratch_path(spark, "fact_interaction")
    write_keyed(fact_interaction(old, dim), path, ["uniprot_a"], BUCKETS)
    refresh_interaction(old, new, dim, path, BUCKETS)
    return read_keyed(spark, path)


@query(
    "S9 S10 A2 Q6",
    with_ctes(
        STAR_SQL,
        "SELECT acc AS uniprot_accession, efo_id, CAST(score AS DOUBLE) AS overall_score FROM evidence",
    ),
)
def disease_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    star = build_star(spark, B.bronze(spark, sf), B.editorial(spark, sf))
    new = stash(star["stg_ot_associations"], "associations")
    old = stash(earlier(new, "ensembl_gene_id", "overall_score"), "associations")
    rest = star["stg_ot_targets"], star["stg_uniprot"].select("uniprot_accession"), star["stg_ot_diseases"]
    path = scratch_path(spark, "fact_protein_disease")
    write_keyed(fact_protein_disease(old, *rest), path, ["uniprot_accession"], BUCKETS)
    refresh_disease(old, new, *rest, path, BUCKETS)
    return read_keyed(spark, path).withColumn("overall_score", F.col("overall_score").cast("double"))


@query(
    "S9 S10",
    """WITH before AS (
           SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
           FROM orders WHERE o_orderkey % 30 <> 1
           UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 40 = 2),
       after AS (SELECT o_orderkey, o_orderstatus FROM orders)
       SELECT o_orderkey, sum(side)::BIGINT AS change
       FROM (SELECT *, -1 AS side FROM before UNION ALL SELECT *, 1 FROM after)
       GROUP BY o_orderkey, o_orderstatus HAVING sum(side) <> 0""",
)
def version_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that one version of a relation has more often than the other."""
    after = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    status = F.when(F.col("o_orderkey") % 20 == 0, "X").otherwise(F.col("o_orderstatus"))
    before = (
        after.where("o_orderkey % 30 <> 1").withColumn("o_orderstatus", status)
        .unionByName(after.where("o_orderkey % 40 = 2"))
    )
    return changed_rows(before, after, ["o_orderkey"])
