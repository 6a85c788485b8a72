"""The generic operators directly on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar.functions.lists import sort_by_score, split_labels
from keystar.functions.scores import as_percent
from keystar.functions.texts import truncated
from keystar.operators.composition import letter_composition
from keystar.operators.dedup import (
    keep_first,
    max_evidence,
    ordered_distinct,
    pair_max,
    symmetric,
)
from keystar.operators.patch import check_patch, member_check, patch_by_key, split_members
from keystar.operators.ranking import flatten_list, nest, top_n
from keystar.operators.resolve import count_edges, match_symbols, resolve_edges, resolve_ids
from keystar.plans.lookup import search
from keystar.plans.marts import best_group
from keystar.sources.readers import spread
from workload.registry import query, table


@query(
    "Q5 J2 P11 A1 X13",
    """SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b,
              max(l_quantity) AS score
       FROM lineitem
       WHERE l_partkey <> l_suppkey AND l_partkey IN (SELECT p_partkey FROM part)
         AND l_suppkey IN (SELECT s_suppkey FROM supplier)
       GROUP BY ALL""",
)
def pair_dedup(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_quantity").alias("score")
    )
    parts = table(spark, sf, "part").select("p_partkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey")
    return pair_max(edges, "a", "b", "score", parts, suppliers)


@query(
    "J7",
    """WITH p AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b
                  FROM lineitem WHERE l_partkey <> l_suppkey AND l_partkey IN (SELECT p_partkey FROM part)
                    AND l_suppkey IN (SELECT s_suppkey FROM supplier))
       SELECT k AS node, count(*) AS partners
       FROM (SELECT a AS k FROM p UNION ALL SELECT b FROM p) GROUP BY k""",
)
def ego_degrees(spark: SparkSession, sf: str) -> DataFrame:
    ends = symmetric(pair_dedup(spark, sf), "a", "b", "node", "other")
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("partners"))


@query(
    "Q6 J5 A2",
    """SELECT o_custkey, l_partkey, max(l_discount) AS l_discount
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       WHERE o_custkey IN (SELECT c_custkey FROM customer) AND l_partkey IN (SELECT p_partkey FROM part)
       GROUP BY ALL HAVING max(l_discount) >= 0.05""",
)
def max_floor(spark: SparkSession, sf: str) -> DataFrame:
    return max_evidence(
        table(spark, sf, "lineitem"),
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"),
        foreign="l_orderkey",
        anchor="o_custkey",
        subject="l_partkey",
        score="l_discount",
        anchors=table(spark, sf, "customer").select("c_custkey"),
        subjects=table(spark, sf, "part").select("p_partkey"),
        floor=F.lit(0.05),
    )


@query(
    "Q3 P12 A3 J4",
    """SELECT c_custkey, c_name, max(CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3
                   WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 0 END)::INTEGER AS max_phase
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""",
)
def category_phase(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    phase = (
        F.when(priority == "1-URGENT", 4)
        .when(priority == "2-HIGH", 3)
        .when(priority == "3-MEDIUM", 2)
        .when(priority == "5-LOW", 0)
    )
    best = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max(phase).alias("max_phase"))
    return (
        table(spark, sf, "customer")
        .select("c_custkey", "c_name")
        .join(best, F.col("c_custkey") == F.col("o_custkey"), "left")
        .drop("o_custkey")
    )


# Label, group, priority; both labels of a priority belong to one group.
_GROUPS = [
    ("red", "Warm", 1),
    ("hot", "Warm", 1),
    ("blue", "Cold", 2),
    ("cold", "Cold", 2),
    ("ring", "Round", 3),
    ("gear", "Round", 3),
]
_GROUP_VALUES = ", ".join(f"('{w}', '{g}', {p})" for w, g, p in _GROUPS)


@query(
    "X2 A4 P13 J9",
    f"""SELECT p_partkey, coalesce(family, 'Unclassified') AS family
        FROM part LEFT JOIN (
            SELECT k, family FROM (
                SELECT k, family, row_number() OVER (PARTITION BY k ORDER BY priority, family) AS rn
                FROM (SELECT p_partkey AS k, trim(unnest(string_split(p_name, ' '))) AS w FROM part)
                JOIN (VALUES {_GROUP_VALUES}) g(w, family, priority) USING (w)) WHERE rn = 1
        ) ON k = p_partkey""",
)
def argmin_family(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    groups = spark.createDataFrame(_GROUPS, "word string, family string, priority int")
    best = best_group(part, "p_partkey", "p_name", groups, sep=" ")
    return part.join(best, "p_partkey", "left").select(
        "p_partkey", F.coalesce("family", F.lit("Unclassified")).alias("family")
    )


@query(
    "A14",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
)
def keep_first_event(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return keep_first(events, ["user_id"], "event_id")


@query(
    "A14",
    """SELECT kind, event_id, value FROM (
           SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, event_id, value FROM events)
       QUALIFY row_number() OVER (PARTITION BY kind ORDER BY event_id) = 1""",
)
def keep_first_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Few keys with thousands of rows each, one of them NULL."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    events = table(spark, sf, "events").select(kind.alias("kind"), "event_id", "value")
    return keep_first(events, ["kind"], "event_id")


@query(
    "A15",
    """SELECT user_id, string_agg(event_type, ',' ORDER BY first) AS event_types
       FROM (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY ALL)
       GROUP BY user_id""",
)
def ordered_distinct_types(spark: SparkSession, sf: str) -> DataFrame:
    listed = ordered_distinct(table(spark, sf, "events"), "user_id", "event_type", "event_id")
    return listed.withColumn("event_types", F.array_join("event_types", ","))


@query(
    "A16",
    """WITH e AS (SELECT event_id // 6 AS id, event_id AS ord, event_type AS src,
                         CAST(user_id % 3 AS VARCHAR) AS alias FROM events),
            g AS (SELECT id,
                         list(alias ORDER BY ord) FILTER (WHERE src = 'purchase') AS h,
                         list(alias ORDER BY ord) FILTER (WHERE src = 'view') AS v,
                         list(alias ORDER BY ord) FILTER (WHERE src = 'click') AS c
                  FROM e WHERE src IN ('purchase', 'view', 'click') GROUP BY id),
            b AS (SELECT *, [z FOR z IN coalesce(v, []) IF list_contains(coalesce(c, []), z)] AS x FROM g)
       SELECT id, CASE WHEN h IS NOT NULL THEN coalesce([z FOR z IN h IF list_contains(x, z)][1], h[1])
                       WHEN len(x) = 1 THEN x[1] ELSE coalesce(c[1], v[1]) END AS accession
       FROM b""",
)
def tiered_resolution(spark: SparkSession, sf: str) -> DataFrame:
    aliases = table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 6).alias("string_protein_id"),
        (F.col("user_id") % 3).cast("string").alias("alias"),
        F.col("event_type").alias("source"),
        F.col("event_id").alias("ord"),
    )
    return resolve_ids(aliases, hgnc="purchase", ensembl="view", accession="click")


_EDGES = """
    SELECT user_id % 30 AS a, event_id % 30 AS b, value AS score FROM events WHERE value >= 5"""
_MAPPED = """
    SELECT n_nationkey AS id, CASE WHEN n_regionkey = 0 THEN '' ELSE n_name END AS accession FROM nation"""


def _edges(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Events as edges between nations; some ends are unknown, some map to a blank."""
    edges = table(spark, sf, "events").select(
        (F.col("user_id") % 30).alias("protein1"),
        (F.col("event_id") % 30).alias("protein2"),
        F.col("value").alias("combined_score"),
    )
    mapping = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.when(F.col("n_regionkey") == 0, "").otherwise(F.col("n_name")).alias("accession"),
    )
    return edges, mapping


@query(
    "J6 P10",
    f"""SELECT x.accession AS uniprot_a, y.accession AS uniprot_b, e.score AS combined_score
        FROM ({_EDGES}) e JOIN ({_MAPPED}) x ON x.id = e.a JOIN ({_MAPPED}) y ON y.id = e.b
        WHERE x.accession <> '' AND y.accession <> ''""",
)
def edge_resolve(spark: SparkSession, sf: str) -> DataFrame:
    edges, mapping = _edges(spark, sf)
    return resolve_edges(edges, mapping, min_score=5)[0]


@query(
    "J6 A17",
    f"""SELECT count(*) FILTER (WHERE x.accession <> '' AND y.accession <> '') AS kept,
               count(*) - count(*) FILTER (WHERE x.accession <> '' AND y.accession <> '') AS unmapped
        FROM ({_EDGES}) e LEFT JOIN ({_MAPPED}) x ON x.id = e.a LEFT JOIN ({_MAPPED}) y ON y.id = e.b""",
)
def edge_resolve_counts(spark: SparkSession, sf: str) -> DataFrame:
    edges, mapping = _edges(spark, sf)
    return count_edges(edges, mapping, min_score=5)


_SYMBOLS = "SELECT c_custkey, 'Brand#' || (c_custkey % 30) AS symbol FROM customer"


def _symbols(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("Brand#"), (F.col("c_custkey") % 30).cast("string")).alias("symbol"),
    )
    dim = table(spark, sf, "part").select(
        F.col("p_brand").alias("gene_symbol"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("uniprot_accession"),
    )
    return match_symbols(rows, dim)


@query(
    "J15 Q20",
    f"""SELECT c_custkey, symbol, acc AS uniprot_accession FROM ({_SYMBOLS})
        JOIN (SELECT p_brand, min('P' || p_partkey) AS acc FROM part GROUP BY 1) ON p_brand = symbol""",
)
def symbol_matched(spark: SparkSession, sf: str) -> DataFrame:
    return _symbols(spark, sf)[0]


@query(
    "J15 Q20",
    f"SELECT * FROM ({_SYMBOLS}) WHERE symbol NOT IN (SELECT p_brand FROM part)",
)
def symbol_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return _symbols(spark, sf)[1]


@query(
    "Q8 X1",
    """SELECT doc_id, letter AS amino_acid_code, n AS count,
              floor(CAST(n AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(n_chars AS DOUBLE)
                    * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) AS pct_of_sequence
       FROM (SELECT doc_id, n_chars, letter, length(text) - length(replace(text, letter, '')) AS n
             FROM documents, (SELECT unnest(string_split('ARNDCEQGHILKMFPSTWYV', '')) AS letter)
             WHERE length(text) > 0)""",
)
def letter_counts(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread(table(spark, sf, "documents").select("doc_id", "text", "n_chars"), spark.sparkContext.defaultParallelism)
    return letter_composition(documents, "doc_id", "text", "n_chars")


@query(
    "X7",
    """SELECT doc_id, md5(substring(text, 1, 1022)) AS clipped_md5, length(text) > 1022 AS was_truncated
       FROM documents""",
)
def truncate_flag(spark: SparkSession, sf: str) -> DataFrame:
    clipped, flag = truncated(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(clipped).alias("clipped_md5"), flag.alias("was_truncated")
    )


@query(
    "J8 W2 A8 P24",
    """SELECT c_custkey, rank::INTEGER AS rank, o_orderkey, o_totalprice
       FROM (SELECT c_custkey, o_orderkey, o_totalprice,
                    row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
             FROM customer JOIN orders ON o_custkey = c_custkey) WHERE rank <= 5""",
)
def top_n_lists(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    best = top_n(orders, "o_custkey", 5, F.desc("o_totalprice"), F.asc("o_orderkey"))
    nested = nest(best, "o_custkey", ["o_orderkey", "o_totalprice"], "top_orders")
    lists = (
        table(spark, sf, "customer")
        .select("c_custkey")
        .join(nested, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    return flatten_list(lists, "c_custkey", "top_orders")


@query(
    "O4",
    """SELECT doc_id, string_agg(label, ',' ORDER BY score DESC, label) AS labels
       FROM (SELECT doc_id, 'quality' AS label, coalesce(quality, 0) AS score FROM labels
             UNION ALL SELECT doc_id, 'toxic', coalesce(toxic, 0) FROM labels)
       GROUP BY doc_id""",
)
def sorted_labels(spark: SparkSession, sf: str) -> DataFrame:
    items = F.array(
        F.struct(F.lit("toxic").alias("label"), F.col("toxic").alias("score")),
        F.struct(F.lit("quality").alias("label"), F.col("quality").alias("score")),
    )
    ordered = sort_by_score(items, "score", "label")
    return table(spark, sf, "labels").select(
        "doc_id", F.array_join(F.transform(ordered, lambda x: x["label"]), ",").alias("labels")
    )


@query(
    "X3",
    r"""SELECT doc_id, array_to_string([p FOR p IN
                  [regexp_replace(t, '^[\s\x0B\x1C-\x1F\x{85}\p{Z}]+|[\s\x0B\x1C-\x1F\x{85}\p{Z}]+$', '', 'g')
                   FOR t IN string_split(text, ',')] IF p <> ''], '|') AS chips
        FROM documents""",
)
def label_chips(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(split_labels(F.col("text")), "|").alias("chips")
    )


@query(
    "X11",
    """SELECT event_id, round_even(greatest(0.0::DOUBLE, least(1.0::DOUBLE, value / 100)) * 100, 0)::INTEGER AS pct
       FROM events""",
)
def clamped_percent(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", as_percent(F.col("value") / 100).alias("pct"))


_RANK = """
    SELECT p_partkey, p_brand, p_name FROM part
    WHERE p_name ILIKE '%{q}%' OR p_brand ILIKE '%{q}%' OR CAST(p_partkey AS VARCHAR) ILIKE '%{q}%'
    ORDER BY CASE WHEN p_name ILIKE '{q}%' OR p_brand ILIKE '{q}%' OR CAST(p_partkey AS VARCHAR) ILIKE '{q}%'
                  THEN 0 ELSE 1 END, length(p_name), p_partkey
    LIMIT 20"""


@query("Q10 P17 O2", _RANK.format(q="ring"))
def search_contains(spark: SparkSession, sf: str) -> DataFrame:
    return search(table(spark, sf, "part"), "ring", symbol="p_brand", name="p_name", key="p_partkey")


@query("Q10 P17 O2", _RANK.format(q="red"))
def search_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return search(table(spark, sf, "part"), "red", symbol="p_brand", name="p_name", key="p_partkey")


@query(
    "U4 J12 U2 O6",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN 'patched ' || c_name
                              ELSE c_name END AS c_name
       FROM customer""",
)
def patch_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "customer").select("c_custkey", "c_name")
    patch = (
        table(spark, sf, "customer")
        .where((F.col("c_acctbal") < 0) | (F.col("c_mktsegment") == "BUILDING"))
        .select("c_custkey", F.concat(F.lit("patched "), F.col("c_name")).alias("c_name"))
    )
    merged = patch_by_key(old, patch, "c_custkey")
    check_patch(old, merged)
    return merged.orderBy("c_custkey")


@query(
    "U3",
    """SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50) AS found
       FROM part""",
)
def member_flags(spark: SparkSession, sf: str) -> DataFrame:
    bulk = table(spark, sf, "lineitem").where("l_quantity >= 50")
    result = bulk.select(F.col("l_partkey").alias("p_partkey"))
    return member_check(result, table(spark, sf, "part"), "p_partkey")


@query(
    "U3 J12",
    """SELECT 'missing' AS side, count(*) AS parts FROM part
       WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)
       UNION ALL SELECT 'found', count(*) FROM part
       WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)""",
)
def member_split(spark: SparkSession, sf: str) -> DataFrame:
    bulk = table(spark, sf, "lineitem").where("l_quantity >= 50")
    result = bulk.select(F.col("l_partkey").alias("p_partkey"))
    found, missing = split_members(result, table(spark, sf, "part"), "p_partkey")

    def count(side: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("parts")).select(F.lit(side).alias("side"), "parts")

    return count("found", found).unionByName(count("missing", missing))
