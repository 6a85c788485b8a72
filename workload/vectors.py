"""Neighbours, embeddings and their projection."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.functions.vectors import norm
from keystar.operators.cells import CellIndex, build_index, search, search_texts
from keystar.operators.embedding import embed, masked_mean, project_2d
from keystar.operators.neighbors import cosine_topk
from keystar.operators.patch import member_check
from keystar.operators.quality import coverage
from keystar.plans.embedding_state import STATE, as_embedding, classify_sequences, refresh_embeddings, unseen_texts
from keystar.plans.lookup import map_extract, neighbors_of
from keystar.plans.vectors import assemble_embedding
from keystar.plans.vectors import fact_embedding as embedding_relation
from keystar.plans.vectors import fact_protein_neighbor
from keystar.session import stash
from keystar.sources.readers import spread
from workload.bronze import fact_embedding
from workload.registry import query, table, with_ctes
from workload.star import STAR_SQL, served

_TOPK = """
    SELECT vec_id, neighbor, similarity,
           row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, neighbor)::INTEGER AS rank
    FROM (SELECT a.vec_id, b.vec_id AS neighbor,
                 round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
          FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
    QUALIFY rank <= 20"""


@query("Q15 J13 X14 O5 W1 W4", _TOPK)
def cosine_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    return cosine_topk(table(spark, sf, "embeddings"), "vec_id", "embedding")


@query("Q15 J13", _TOPK)
def cosine_neighbors_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """The same from many small strips."""
    return cosine_topk(table(spark, sf, "embeddings"), "vec_id", "embedding", strip_rows=128)


_COPIES = """
    SELECT vec_id, embedding FROM embeddings UNION ALL
    SELECT 100000 + vec_id, (SELECT embedding FROM embeddings WHERE vec_id = 7) FROM embeddings
    WHERE vec_id % 2 = 0"""


@query("Q15 J13", _TOPK.replace("embeddings a JOIN embeddings b", f"({_COPIES}) a JOIN ({_COPIES}) b"))
def cosine_neighbors_copies(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the rows are one vector: ties at every rank."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    one = vectors.where("vec_id = 7").select("embedding").scalar()
    copies = vectors.where("vec_id % 2 = 0").select(
        (F.col("vec_id") + 100000).alias("vec_id"), one.alias("embedding")
    )
    return cosine_topk(vectors.unionByName(copies), "vec_id", "embedding")


@query(
    "W4 J13 Q15",
    """WITH m AS (SELECT label, list(v ORDER BY d) AS mean FROM (
                     SELECT label, d, round(avg(embedding[d]::DOUBLE), 9) AS v
                     FROM embeddings, (SELECT unnest(range(1, 65)) AS d) GROUP BY label, d)
                 GROUP BY label)
       SELECT label, neighbor, similarity,
              row_number() OVER (PARTITION BY label ORDER BY similarity DESC, neighbor)::INTEGER AS rank
       FROM (SELECT a.label, b.label AS neighbor,
                    round(list_cosine_similarity(a.mean, b.mean), 6) AS similarity
             FROM m a JOIN m b ON a.label <> b.label)
       QUALIFY rank <= 20""",
)
def label_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    """Mean vectors of the labels: fewer rows than k."""
    cells = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("d", "x"))
    means = cells.groupBy("label", "d").agg(F.round(F.avg(F.col("x").cast("double")), 9).alias("v"))
    listed = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("d", "v"))).alias("c"))
    return cosine_topk(listed.select("label", F.col("c.v").alias("mean")), "label", "mean")


@query(
    "X14",
    """SELECT vec_id, round(sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])), 6) AS length
       FROM embeddings""",
)
def vector_norms(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.round(norm(F.col("embedding")), 6).alias("length")
    )


@query(
    "Q13 J14 O3",
    with_ctes(
        {**STAR_SQL, "topk": _TOPK},
        """SELECT 'P' || t.vec_id AS uniprot_accession, t.rank, p.acc AS accession, p.gene_symbol,
                  p.protein_name, round_even(CAST(t.similarity::FLOAT AS DOUBLE), 3) AS similarity
           FROM topk t JOIN protein p ON p.acc = 'P' || t.neighbor
           QUALIFY row_number() OVER (PARTITION BY t.vec_id ORDER BY t.rank) <= 10""",
    ),
)
def neighbor_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Vector ids sort as numbers here and as texts below, so ties are kept apart by rank."""
    pairs = cosine_topk(table(spark, sf, "embeddings"), "vec_id", "embedding")
    neighbors = pairs.select(
        F.concat(F.lit("P"), F.col("vec_id").cast("string")).alias("uniprot_accession"),
        F.concat(F.lit("P"), F.col("neighbor").cast("string")).alias("neighbor_accession"),
        F.col("similarity").cast("float").alias("similarity"),
        "rank",
    )
    return neighbors_of(neighbors, served(spark, sf)["dim_protein"])


@query(
    "Q15 S11",
    f"""SELECT 'P' || vec_id AS uniprot_accession, 'P' || neighbor AS neighbor_accession,
               similarity::FLOAT AS similarity, rank
        FROM ({_TOPK.replace('similarity DESC, neighbor)', "similarity DESC, 'P' || neighbor)")})""",
)
def fact_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    return fact_protein_neighbor(fact_embedding(spark, sf))


@query(
    "U3",
    f"""SELECT vec_id, vec_id IN (SELECT neighbor FROM ({_TOPK})) AS found FROM embeddings""",
)
def neighbor_members(spark: SparkSession, sf: str) -> DataFrame:
    """Which vectors are somebody's neighbour."""
    vectors = table(spark, sf, "embeddings")
    pairs = cosine_topk(vectors, "vec_id", "embedding").select(F.col("neighbor").alias("vec_id"))
    return member_check(pairs, vectors, "vec_id")


# The stand-in model: a token is its code point, one value per dimension and token.
DIM = 8
START, END = 1, 2


def stand_in_model() -> Callable[[np.ndarray], np.ndarray]:
    steps = np.arange(1, DIM + 1, dtype=np.uint32)

    def predict(texts: np.ndarray) -> np.ndarray:
        points = [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in texts]
        width = max(map(len, points)) + 2
        tokens = np.zeros((len(points), width), dtype=np.uint32)
        mask = np.zeros((len(points), width), dtype=bool)
        for i, row in enumerate(points):
            tokens[i, 0], tokens[i, len(row) + 1] = START, END
            tokens[i, 1 : len(row) + 1] = row
            mask[i, : len(row) + 2] = True
        return masked_mean((tokens[:, :, None] * steps) % 97, mask)

    return predict


_EMBED = f"""
    SELECT doc_id, d AS dim, length(text) > 1022 AS was_truncated,
           (list_sum([(unicode(c) * d) % 97 FOR c IN string_split(substring(text, 1, 1022), '')])
            + (1 * d) % 97 + (2 * d) % 97)::FLOAT / (least(length(text), 1022) + 2)::FLOAT AS value
    FROM documents, (SELECT unnest(range(1, {DIM + 1})) AS d)"""


@query(
    "Q16 F1 X7 Q18",
    f"SELECT doc_id, dim::INTEGER AS dim, was_truncated, value FROM ({_EMBED})",
)
def embed_batch(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread(table(spark, sf, "documents").select("doc_id", "text"), spark.sparkContext.defaultParallelism)
    embedded = embed(documents, "text", stand_in_model)
    values = embedded.select("doc_id", "was_truncated", F.posexplode("embedding").alias("pos", "v"))
    return values.select(
        "doc_id",
        (F.col("pos") + 1).alias("dim"),
        "was_truncated",
        F.col("v").alias("value"),
    )


@query(
    "A18 A17",
    """SELECT (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM documents) AS right_rows,
              (SELECT count(*) FROM documents WHERE length(text) > 1022) AS truncated,
              0::BIGINT AS null_coordinates""",
)
def embedding_coverage(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("uniprot_accession"), F.col("text").alias("sequence")
    )
    fact = embedding_relation(spread(documents, spark.sparkContext.defaultParallelism), stand_in_model, "stand-in")
    return coverage(
        documents,
        fact,
        {
            "truncated": F.col("was_truncated"),
            "null_coordinates": F.col("umap_x").isNull() | F.col("umap_y").isNull(),
        },
    )


@query("Q17")
def pca_projection(spark: SparkSession, sf: str) -> DataFrame:
    projected = project_2d(table(spark, sf, "embeddings"), "embedding")
    return projected.select("vec_id", "umap_x", "umap_y")


# The two largest eigenvalues of the unit vectors' covariance, by power iteration.
_AXES = """
    WITH RECURSIVE u AS (
        SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE
            / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS v
        FROM embeddings),
    cell AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM u),
    cov AS (SELECT a.d AS i, b.d AS j, covar_pop(a.x, b.x) AS c
            FROM cell a JOIN cell b USING (vec_id) GROUP BY a.d, b.d),
    lines AS (SELECT i, list(c ORDER BY j) AS r FROM cov GROUP BY i),
    m AS (SELECT list(r ORDER BY i) AS m FROM lines),
    one AS (
        SELECT 0 AS step, list_transform(m[1], lambda x: 1.0::DOUBLE) AS v FROM m
        UNION ALL
        SELECT step + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))) FROM (
            SELECT step, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM one, m
            WHERE step < 400)),
    first AS (
        SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS size
        FROM one, m WHERE step = 400),
    two AS (
        SELECT 0 AS step,
               list_transform(v, lambda x, i: CASE WHEN i % 2 = 0 THEN 1.0 ELSE 0.5 END::DOUBLE) AS v
        FROM first
        UNION ALL
        SELECT step + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))) FROM (
            SELECT step, list_transform(m, lambda r, i: list_dot_product(r, two.v)
                - first.size * first.v[i] * list_dot_product(first.v, two.v)) AS w
            FROM two, m, first WHERE step < 400))"""

_PRINCIPAL = f"""{_AXES}
    SELECT (SELECT count(*) FROM embeddings) AS points,
           round((SELECT size FROM first), 4) AS first_variance,
           (SELECT round(list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))), 4)
            FROM two, m WHERE step = 400) AS second_variance,
           true AS uncorrelated"""


@query("Q17", _PRINCIPAL)
def pca_properties(spark: SparkSession, sf: str) -> DataFrame:
    """What only the principal plane has: the largest variances, uncorrelated."""
    points = pca_projection(spark, sf)
    return points.agg(
        F.count(F.lit(1)).alias("points"),
        F.round(F.var_pop("umap_x"), 4).alias("first_variance"),
        F.round(F.var_pop("umap_y"), 4).alias("second_variance"),
        (F.abs(F.corr("umap_x", "umap_y")) < 1e-3).alias("uncorrelated"),
    )


# Index of each (application, data set, relation), written once for the queries that search it.
_indexes: dict[tuple[str, str], CellIndex] = {}


def indexed(spark: SparkSession, sf: str) -> CellIndex:
    at = (spark.sparkContext.applicationId, sf)
    if at not in _indexes:
        _indexes[at] = build_index(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return _indexes[at]


def new_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors that are not in the table: each one pulled towards the first component's axis."""
    return table(spark, sf, "embeddings").where("vec_id % 5 = 0").select(
        "vec_id",
        F.transform("embedding", lambda x, i: x.cast("double") + F.when(i == 0, 0.25).otherwise(0.0)).alias("v"),
    )


_NEW = """
    SELECT vec_id AS query_id, list_transform(embedding, lambda x, i: x::DOUBLE + CASE WHEN i = 1 THEN 0.25 ELSE 0 END) AS v
    FROM embeddings WHERE vec_id % 5 = 0"""
_FOUND = f"""
    SELECT query_id, e.vec_id AS id, round(list_cosine_similarity(q.v, e.embedding::DOUBLE[]), 6) AS similarity
    FROM ({_NEW}) q, embeddings e"""


@query(
    "Q15 J13",
    f"""SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id)::INTEGER AS rank
        FROM ({_FOUND}) QUALIFY rank <= 20""",
)
def vector_search_exact(spark: SparkSession, sf: str) -> DataFrame:
    """New vectors against every cell."""
    return search(indexed(spark, sf), new_vectors(spark, sf), "vec_id", "v")


# Share of the cells that are read: what reaches the recall below on vectors that are spread
# evenly, where cells help least.
PROBE_SHARE = 0.7


def probes_of(index: CellIndex) -> int:
    return max(1, int(PROBE_SHARE * len(index.centroids)))


@query(
    "Q15 J13",
    """SELECT (SELECT count(*) FROM embeddings WHERE vec_id % 5 = 0) AS queries, true AS recall_reached,
              true AS fewer_cells""",
)
def vector_search_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Ten best of a part of the cells, held against the exact ten."""
    index, asked = indexed(spark, sf), new_vectors(spark, sf)
    exact = search(index, asked, "vec_id", "v", 10)
    found = search(index, asked, "vec_id", "v", 10, probes_of(index))
    hits = exact.join(found.select("query_id", "id").withColumn("hit", F.lit(1)), ["query_id", "id"], "left")
    return hits.agg(
        F.count_distinct("query_id").alias("queries"),
        (F.count("hit") / F.count(F.lit(1)) >= 0.9).alias("recall_reached"),
        F.lit(probes_of(index) < len(index.centroids)).alias("fewer_cells"),
    )


@query(
    "Q15 F1",
    f"""WITH v AS (SELECT doc_id, list(value::DOUBLE ORDER BY dim) AS v FROM ({_EMBED}) GROUP BY doc_id),
        asked AS (SELECT 'new ' || doc_id AS query_id, v FROM v WHERE doc_id % 50 = 0)
        SELECT query_id, rank, similarity FROM (
            SELECT query_id, round(list_cosine_similarity(asked.v, v.v), 6) AS similarity,
                   row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(asked.v, v.v), 6) DESC, doc_id)::INTEGER AS rank
            FROM asked, v WHERE asked.v IS NOT NULL)
        WHERE rank <= 5""",
)
def text_search(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that are dropped in: embedded by the index's model, then searched in all cells."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    # The model reads no further, so no more than that is dealt out.
    seen = documents.select("doc_id", F.substring("text", 1, K.MAX_SEQUENCE).alias("text"))
    embedded = embed(spread(seen, spark.sparkContext.defaultParallelism), "text", stand_in_model)
    index = build_index(stash(embedded.select("doc_id", "embedding"), "embedded"), "doc_id", "embedding")
    asked = documents.where("doc_id % 50 = 0").select(
        F.concat(F.lit("new "), F.col("doc_id").cast("string")).alias("query_id"), "text"
    )
    found = search_texts(index, asked, "query_id", "text", stand_in_model, 5)
    return found.select("query_id", "rank", "similarity")


def _sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as proteins; every ninth has the text of the one before it."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    other = docs.select((F.col("doc_id") + 1).alias("doc_id"), F.col("text").alias("before"))
    text = F.when(F.col("doc_id") % 9 == 0, F.coalesce("before", "text")).otherwise(F.col("text"))
    return docs.join(other, "doc_id", "left").select(
        F.concat(F.lit("P"), F.col("doc_id").cast("string")).alias("uniprot_accession"), text.alias("sequence"),
        "doc_id",
    )


def _earlier(spark: SparkSession, sf: str) -> DataFrame:
    """What the last run saw: a tenth was not there, a seventh read otherwise, some are gone now."""
    now = _sequences(spark, sf)
    changed = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("Old "), "sequence")).otherwise(F.col("sequence"))
    kept = now.where("doc_id % 10 <> 3").select("uniprot_accession", changed.alias("sequence"))
    gone = now.where("doc_id % 11 = 0").select(F.concat(F.lit("Z"), "uniprot_accession").alias("uniprot_accession"), "sequence")
    return kept.unionByName(gone)


_STATES = {
    "documents_now": """
        SELECT d.doc_id, 'P' || d.doc_id AS acc,
               CASE WHEN d.doc_id % 9 = 0 THEN coalesce(b.text, d.text) ELSE d.text END AS text
        FROM documents d LEFT JOIN documents b ON b.doc_id = d.doc_id - 1""",
    "documents_before": """
        SELECT acc, CASE WHEN doc_id % 7 = 0 THEN 'Old ' || text ELSE text END AS text
        FROM documents_now WHERE doc_id % 10 <> 3
        UNION ALL SELECT 'Z' || acc, text FROM documents_now WHERE doc_id % 11 = 0""",
}


@query(
    "Q18 Q16 A18",
    with_ctes(
        _STATES,
        """SELECT coalesce(n.acc, b.acc) AS uniprot_accession,
                  CASE WHEN b.acc IS NULL THEN 'new' WHEN n.acc IS NULL THEN 'gone'
                       WHEN b.text = n.text THEN 'same' ELSE 'changed' END AS status,
                  n.acc IS NOT NULL AND n.text NOT IN (SELECT text FROM documents_before) AS sent
           FROM documents_now n FULL JOIN documents_before b ON b.acc = n.acc""",
    ),
)
def embedding_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What a second run finds, and whose texts the model has to see."""
    now = _sequences(spark, sf)
    state = _earlier(spark, sf).select(
        "uniprot_accession",
        F.sha2("sequence", 256).alias("sequence_digest"),
        F.lit("v1").alias("model_version"),
    )
    unseen = unseen_texts(now, state, "v1").select("sequence_digest", F.lit(True).alias("sent"))
    found = classify_sequences(now, state, "v1")
    return found.join(unseen, "sequence_digest", "left").select(
        "uniprot_accession", "status", F.coalesce("sent", F.lit(False)).alias("sent")
    )


@query(
    "Q18 Q16 F1",
    with_ctes(
        _STATES,
        f"""SELECT acc AS uniprot_accession, dim::INTEGER AS dim, value
            FROM documents_now n JOIN ({_EMBED.replace("FROM documents,", "FROM (SELECT DISTINCT text, text AS doc_id FROM documents_now),")}) e
                ON e.doc_id = n.text""",
    ),
)
def embedding_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings after the second run: kept where nothing changed, made where something did."""
    nothing = spark.createDataFrame([], STATE)
    first = stash(refresh_embeddings(_earlier(spark, sf), nothing, stand_in_model, "v1"), "state")
    second = refresh_embeddings(_sequences(spark, sf), first, stand_in_model, "v1")
    return second.select("uniprot_accession", F.posexplode("embedding").alias("pos", "value")).select(
        "uniprot_accession", (F.col("pos") + 1).alias("dim"), "value"
    )


# Coordinates on both axes, each turned so that its largest weight is positive.
_PLACED = f"""{_AXES.replace("FROM embeddings", "FROM vectors")},
    signed AS (
        SELECT first.v AS a, two.v AS b,
               sign(list_sort(list_transform(first.v, lambda w: [abs(w), w]), 'DESC')[1][2]) AS sa,
               sign(list_sort(list_transform(two.v, lambda w: [abs(w), w]), 'DESC')[1][2]) AS sb
        FROM first, two WHERE step = 400)
    SELECT vec_id AS acc, sa * list_dot_product(u.v, a) AS x, sb * list_dot_product(u.v, b) AS y FROM u, signed"""


@query(
    "Q11 S15 P22 Q17 Q18 J10 A5 A6",
    with_ctes(
        {
            **STAR_SQL,
            "vectors": f"""
                SELECT 'P' || doc_id AS vec_id, list(value ORDER BY dim) AS embedding FROM ({_EMBED})
                WHERE 'P' || doc_id IN (SELECT acc FROM protein WHERE sequence IS NOT NULL) GROUP BY doc_id""",
        },
        f"""SELECT p.acc AS uniprot_accession, p.gene_symbol, p.family_group, round(e.x, 3) AS umap_x,
                  round(e.y, 3) AS umap_y, coalesce(d.n, 0) AS disease_count, coalesce(g.n, 0) AS drug_count
           FROM protein p JOIN ({_PLACED}) e ON e.acc = p.acc
           LEFT JOIN (SELECT acc, count(*) AS n FROM evidence GROUP BY acc) d ON d.acc = p.acc
           LEFT JOIN (SELECT t.acc, count(DISTINCT chembl_id) AS n FROM triple t
                      JOIN drug USING (chembl_id) WHERE max_phase >= 3 GROUP BY t.acc) g ON g.acc = p.acc""",
    ),
)
def map_of_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """From sequences to the map: embedded, projected, joined with their counts."""
    star = served(spark, sf)
    sequences = star["dim_protein"].where("sequence IS NOT NULL").select("uniprot_accession", "sequence")
    state = refresh_embeddings(sequences, spark.createDataFrame([], STATE), stand_in_model, "v1")
    fact = assemble_embedding(stash(as_embedding(state), "state"), "v1")
    points = map_extract(star.extended({"fact_embedding": lambda: stash(fact, "fact")}))
    return points.withColumns(
        {c: F.round(F.col(c).cast("double"), 3) for c in ("umap_x", "umap_y")}
    )
