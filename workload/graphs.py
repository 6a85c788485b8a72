"""Walks over links: areas of the disease ontology, accessions that were replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keystar.operators.graph import follow_forwards
from keystar.plans.accessions import ambiguous, resolve_accessions
from keystar.plans.diseases import disease_areas
from keystar.plans.warehouse import build_star
from workload import bronze as B
from workload.registry import query, table, with_ctes
from workload.star import STAR_SQL


def disease_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as terms: two trees laid over each other, links to nowhere, and two kinds of
    cycles, with and without a way out."""
    k = F.col("c_custkey")

    def term(number: Column) -> Column:
        return F.concat(F.lit("EFO_"), number.cast("string"))

    pair = F.pmod(k, F.lit(40))
    closed = pair.isin(5, 6)
    parents = F.array(
        F.when((k >= 8) & ~closed, term(F.floor(k / 4))),
        F.when((k >= 8) & ~closed & (k % 3 == 0), term(F.floor(k / 9))),
        F.when(pair.isin(5, 25), term(k + 1)),
        F.when(pair.isin(6, 26), term(k - 1)),
        F.when(k % 17 == 0, term(k + 10_000_000)),
    )
    return table(spark, sf, "customer").select(
        term(k).alias("efo_id"), F.array_compact(parents).alias("parents")
    )


_TERMS = {
    "term": "SELECT c_custkey AS k, 'EFO_' || c_custkey AS efo_id FROM customer",
    "link": """
        SELECT 'EFO_' || k AS child, 'EFO_' || p AS parent FROM (
            SELECT k, k // 4 AS p FROM term WHERE k >= 8 AND k % 40 NOT IN (5, 6)
            UNION SELECT k, k // 9 FROM term WHERE k >= 8 AND k % 40 NOT IN (5, 6) AND k % 3 = 0
            UNION SELECT k, k + 1 FROM term WHERE k % 40 IN (5, 25)
            UNION SELECT k, k - 1 FROM term WHERE k % 40 IN (6, 26))
        WHERE 'EFO_' || p IN (SELECT efo_id FROM term)""",
    # Longer ways only go around a cycle.
    "walk": """
        SELECT efo_id, efo_id AS area_id, 0 AS distance FROM term
        WHERE efo_id NOT IN (SELECT child FROM link)
        UNION
        SELECT child, area_id, distance + 1 FROM walk JOIN link ON parent = efo_id
        WHERE distance < 40""",
    "area": "SELECT efo_id, area_id, min(distance) AS distance FROM walk GROUP BY ALL",
}


def _recursive(ctes: dict[str, str], final: str) -> str:
    return with_ctes(ctes, final).replace("WITH ", "WITH RECURSIVE ", 1)


@query("Q2 P5", _recursive(_TERMS, "SELECT efo_id, area_id, distance::INTEGER AS distance FROM area"))
def ontology_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Every topmost term above each disease, with the least number of steps to it."""
    return disease_areas(disease_terms(spark, sf))


@query(
    "Q2",
    _recursive(
        {**STAR_SQL, **_TERMS},
        """SELECT d.efo_id, d.disease_name, coalesce(n.disease_name, a.area_id) AS therapeutic_area
           FROM disease d LEFT JOIN (
               SELECT efo_id, area_id FROM area
               QUALIFY row_number() OVER (PARTITION BY efo_id ORDER BY distance, area_id) = 1) a USING (efo_id)
           LEFT JOIN disease n ON n.efo_id = a.area_id""",
    ),
)
def dim_disease_areas(spark: SparkSession, sf: str) -> DataFrame:
    terms = disease_terms(spark, sf)
    return build_star(spark, B.bronze(spark, sf), B.editorial(spark, sf), terms=terms)["dim_disease"]


def forwards(spark: SparkSession, sf: str) -> DataFrame:
    """What became of the edges' unknown ids: single links, chains of three, merges, splits,
    cycles, dead ends, and a current id that is listed as old."""
    k = F.col("s_suppkey")

    def x(number: Column) -> Column:
        return F.concat(F.lit("X"), number.cast("string"))

    def p(number: Column) -> Column:
        return F.concat(F.lit("P"), number.cast("string"))

    last = F.pmod(k, F.lit(10))
    new = (
        F.when(last < 3, F.array(p(k)))
        .when(last == 3, F.array(F.concat(F.lit("Q"), k.cast("string"))))
        .when(last.isin(4, 5, 8), F.array(x(k + 1)))
        .when(last == 6, F.array(p(k), p(k)))
        .when(last == 7, F.array(p(k), p(k + 1)))
        .otherwise(F.array(x(k - 1)))
    )
    old = table(spark, sf, "supplier").select(x(k).alias("old"), F.explode(new).alias("new"))
    listed = table(spark, sf, "supplier").where(last == 1).select(p(k).alias("old"), p(k + 1).alias("new"))
    return old.unionByName(listed)


_FORWARDS = {
    "links": """
        SELECT DISTINCT * FROM (
            SELECT 'X' || s_suppkey AS old, unnest(CASE
                WHEN s_suppkey % 10 < 3 THEN ['P' || s_suppkey]
                WHEN s_suppkey % 10 = 3 THEN ['Q' || s_suppkey]
                WHEN s_suppkey % 10 IN (4, 5, 8) THEN ['X' || (s_suppkey + 1)]
                WHEN s_suppkey % 10 = 6 THEN ['P' || s_suppkey]
                WHEN s_suppkey % 10 = 7 THEN ['P' || s_suppkey, 'P' || (s_suppkey + 1)]
                ELSE ['X' || (s_suppkey - 1)] END) AS new
            FROM supplier)""",
    "walks": """
        SELECT old, new AS reached FROM links
        UNION
        SELECT walks.old, links.new FROM walks JOIN links ON links.old = walks.reached""",
    "resolution": """
        SELECT old AS id, CASE WHEN n = 1 THEN first END AS resolved, n AS targets,
               CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'split' WHEN turns THEN 'cycle' ELSE 'gone' END AS status
        FROM (SELECT old, count(*) FILTER (reached IN (SELECT 'P' || p_partkey FROM part)) AS n,
                     min(reached) FILTER (reached IN (SELECT 'P' || p_partkey FROM part)) AS first,
                     bool_or(reached IN (SELECT old FROM walks WHERE old = reached)) AS turns
              FROM walks GROUP BY old)""",
}


@query("P1 A16", _recursive(_FORWARDS, "SELECT id, resolved, targets, status FROM resolution"))
def accession_resolution(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "part").select(F.concat(F.lit("P"), F.col("p_partkey")).alias("uniprot_accession"))
    return resolve_accessions(forwards(spark, sf), base)


@query(
    "P1 A17",
    _recursive(_FORWARDS, "SELECT id, targets, status FROM resolution WHERE status <> 'resolved'"),
)
def accession_review(spark: SparkSession, sf: str) -> DataFrame:
    return ambiguous(accession_resolution(spark, sf))


@query(
    "Q5 J2 A1",
    _recursive(
        {
            **STAR_SQL,
            **_FORWARDS,
            "edge": """
                SELECT coalesce(a.resolved, uniprot_a) AS a, coalesce(b.resolved, uniprot_b) AS b, combined_score
                FROM b_string LEFT JOIN resolution a ON a.id = uniprot_a
                LEFT JOIN resolution b ON b.id = uniprot_b""",
        },
        """SELECT least(a, b) AS uniprot_a, greatest(a, b) AS uniprot_b, max(combined_score) AS combined_score
           FROM edge
           WHERE a <> b AND a IN (SELECT acc FROM protein) AND b IN (SELECT acc FROM protein)
           GROUP BY least(a, b), greatest(a, b)""",
    ),
)
def fact_interaction_forwarded(spark: SparkSession, sf: str) -> DataFrame:
    """Edges whose ends were replaced count for the current accession."""
    built = build_star(
        spark, B.bronze(spark, sf), B.editorial(spark, sf), forwards=forwards(spark, sf)
    )
    return built["fact_interaction"]


@query(
    "A16",
    """WITH RECURSIVE link AS (
           SELECT o_orderkey AS old, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS new
           FROM orders),
       last AS (SELECT o_custkey, max(o_orderkey) AS top FROM orders GROUP BY o_custkey)
       SELECT o_orderkey AS id, top AS resolved, 1::BIGINT AS targets, 'resolved' AS status
       FROM orders JOIN last USING (o_custkey) WHERE o_orderkey <> top""",
)
def order_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Long chains: each order is replaced by the customer's next one, the last is current."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    following = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    links = orders.select(F.col("o_orderkey").alias("old"), following.alias("new"))
    current = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("id"))
    return follow_forwards(links, current)
