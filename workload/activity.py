"""Medians: bioactivity per drug, protein and kind of measurement, and groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar.operators.median import grouped_median
from keystar.plans.marts import fact_bioactivity
from workload.registry import query, table, with_ctes
from workload.star import STAR_SQL, served


def activities(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as measurements of a drug on a protein; returned lines have no comparable value."""
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("CHEMBL"), F.col("l_suppkey")).alias("chembl_id"),
        F.concat(F.lit("P"), F.col("l_partkey") % 40).alias("uniprot_accession"),
        F.when(F.col("l_linestatus") == "O", "IC50").otherwise("Ki").alias("standard_type"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") / 10 + 4).alias("pchembl_value"),
    )


@query(
    "Q7 A3",
    with_ctes(
        {
            **STAR_SQL,
            "activity": """
                SELECT 'CHEMBL' || l_suppkey AS chembl_id, 'P' || (l_partkey % 40) AS uniprot_accession,
                       CASE WHEN l_linestatus = 'O' THEN 'IC50' ELSE 'Ki' END AS standard_type,
                       l_quantity / 10 + 4 AS pchembl_value
                FROM lineitem WHERE l_returnflag <> 'R'""",
        },
        """SELECT chembl_id, uniprot_accession, standard_type, median(pchembl_value) AS pchembl_value,
                  count(*) AS n_assays
           FROM activity
           WHERE uniprot_accession IN (SELECT acc FROM protein) AND chembl_id IN (SELECT chembl_id FROM drug)
           GROUP BY ALL""",
    ),
)
def bioactivity(spark: SparkSession, sf: str) -> DataFrame:
    star = served(spark, sf)
    return fact_bioactivity(activities(spark, sf), star["dim_protein"], star["dim_drug"])


@query(
    "Q7 A3",
    """SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS customer,
              median(o_totalprice) AS price, count(*) AS orders
       FROM orders GROUP BY ALL""",
)
def median_hot_group(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the rows are one group, with nearly as many values as rows; it is narrowed."""
    group = F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("o_custkey"))
    orders = table(spark, sf, "orders").select(group.alias("customer"), "o_totalprice")
    found = grouped_median(orders, ["customer"], "o_totalprice", "price", most=1000)
    return found.withColumnRenamed("n", "orders")


@query("A3", "SELECT median(value) AS middle, count(value) AS n FROM events")
def median_of_all(spark: SparkSession, sf: str) -> DataFrame:
    """One group: the whole table."""
    values = table(spark, sf, "events").select(F.lit(1).alias("one"), "value")
    return grouped_median(values, ["one"], "value", "middle", most=500).drop("one")
