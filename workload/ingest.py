"""Scans and sinks: driver tables are written as landed files and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystar import schemas
from keystar.operators.dedup import keep_first
from keystar.operators.resolve import match_symbols, resolve_edges, resolve_ids
from keystar.plans import ingest
from keystar.plans.rewrite import build_editorial_seed
from keystar.plans.warehouse import build_star, load_bronze
from keystar.session import scratch_path
from keystar.sources import readers, storage
from workload.registry import query, table


def _text_file(lines: DataFrame, name: str, codec: str = "gzip") -> str:
    path = scratch_path(lines.sparkSession, name)
    lines.write.option("compression", codec).text(path)
    return path


def _key(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("p_partkey").cast("string"))


def _value(column: Column) -> Column:
    return F.struct(column.alias("value"))


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as nested protein entries, with missing fields, repeats and decoys."""
    documents = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    name = F.struct(_value(F.col("p_name")).alias("fullName"))
    second = F.struct(_value(F.concat(F.lit("sub "), F.col("p_name"))).alias("fullName"))
    no_name = F.lit(None).cast(T.StructType([T.StructField("fullName", T.StructType([T.StructField("value", T.StringType())]))]))
    texts = F.array(_value(F.col("p_type")), _value(F.lit("later text")))
    none = F.array().cast("array<struct<value:string>>")

    def comment(kind: str, body: Column) -> Column:
        return F.struct(F.lit(kind).alias("commentType"), body.alias("texts"))

    def xref(database: str, id: Column, *properties: Column) -> Column:
        listed = F.array(*properties) if properties else F.lit(None)
        return F.struct(
            F.lit(database).alias("database"),
            id.alias("id"),
            listed.cast("array<struct<key:string,value:string>>").alias("properties"),
        )

    def prop(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    def keyword(value: Column) -> Column:
        return F.struct(value.alias("name"))

    return (
        table(spark, sf, "part")
        .join(documents, F.col("p_partkey") == F.col("doc_id"), "left")
        .select(
            _key("P").alias("primaryAccession"),
            F.when(F.col("p_size") > 10, F.array("p_brand", "p_type")).alias("secondaryAccessions"),
            F.when(
                F.col("p_type") != "PROMO",
                F.array(
                    F.struct(_value(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("geneName")),
                    F.struct(_value(F.lit("other")).alias("geneName")),
                ),
            ).alias("genes"),
            F.struct(
                F.when(F.col("p_size") > 10, name).otherwise(no_name).alias("recommendedName"),
                F.array(second).alias("submissionNames"),
            ).alias("proteinDescription"),
            F.when(
                F.col("text").isNotNull(),
                F.struct(F.col("text").alias("value"), F.col("n_chars").alias("length")),
            ).alias("sequence"),
            F.array(
                comment("CAUTION", texts),
                comment("FUNCTION", F.when(F.col("p_size") > 30, texts).otherwise(none)),
                comment("FUNCTION", texts),
            ).alias("comments"),
            F.array(keyword(F.col("p_type")), keyword(F.lit("")), keyword(F.lit(None).cast("string")), keyword(F.col("p_type"))).alias("keywords"),
            F.array(
                xref("Pfam", F.col("p_type")),
                xref("Pfam", F.col("p_brand")),
                xref("Pfam", F.col("p_type")),
                xref("Other", F.lit("x")),
                xref("STRING", _key("9606.E")),
                xref("Ensembl", _key("T"), prop("ProteinId", F.lit("x")), prop("GeneId", _key("G"))),
                xref("Ensembl", _key("U"), prop("GeneId", _key("G")), prop("GeneId", F.lit("G0x"))),
            ).alias("uniProtKBCrossReferences"),
        )
    )


@query(
    "S1 A15",
    """SELECT 'P' || p_partkey AS primary_accession,
              CASE WHEN p_size > 10 THEN p_brand || '|' || p_type ELSE '' END AS secondary_accessions,
              CASE WHEN p_type <> 'PROMO' THEN split_part(p_name, ' ', 1) END AS gene_symbol,
              CASE WHEN p_size > 10 THEN p_name ELSE 'sub ' || p_name END AS protein_name,
              n_chars AS sequence_length, md5(text) AS sequence_md5,
              CASE WHEN p_size > 30 THEN p_type END AS function_raw,
              p_type || '|' || p_type AS keywords,
              p_type || '|' || p_brand AS pfam_ids,
              'G' || p_partkey || '|G0x' AS ensembl_gene_ids,
              '9606.E' || p_partkey AS string_ids
       FROM part LEFT JOIN documents ON doc_id = p_partkey""",
)
def entry_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "entries")
    _entries(spark, sf).write.json(path, compression="gzip")
    rows = readers.read_entries(spark, path)
    lists = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return rows.select(
        *(F.array_join(c, "|").alias(c) if c in lists else F.col(c) for c in rows.columns if c != "sequence"),
        F.md5("sequence").alias("sequence_md5"),
    )


def _resolved_sql(alias: str) -> str:
    """The mapping of an alias file whose aliases are ``alias``."""
    return f"""
        WITH rows AS (SELECT event_id // 6 AS id, event_id AS ord, event_type AS src,
                             {alias} AS alias FROM events),
             g AS (SELECT id,
                          list(alias ORDER BY ord) FILTER (WHERE src = 'purchase') AS h,
                          list(alias ORDER BY ord) FILTER (WHERE src = 'view') AS v,
                          list(alias ORDER BY ord) FILTER (WHERE src = 'click') AS c
                   FROM rows WHERE src IN ('purchase', 'view', 'click') GROUP BY id),
             b AS (SELECT *, [z FOR z IN coalesce(v, []) IF list_contains(coalesce(c, []), z)] AS x FROM g)
        SELECT 'E' || id AS id,
               CASE WHEN h IS NOT NULL THEN coalesce([z FOR z IN h IF list_contains(x, z)][1], h[1])
                    WHEN len(x) = 1 THEN x[1] ELSE coalesce(c[1], v[1]) END AS accession
        FROM b"""


def _alias_file(spark: SparkSession, sf: str, prefix: str = "A", kinds: int = 3) -> str:
    source = (
        F.when(F.col("event_type") == "purchase", "Ensembl_HGNC_uniprot_ids")
        .when(F.col("event_type") == "view", "Ensembl_UniProt")
        .when(F.col("event_type") == "click", "UniProt_AC")
        .otherwise("BLAST")
    )
    fields = F.array(
        F.concat(F.lit("E"), F.floor(F.col("event_id") / 6).cast("string")),
        F.concat(F.lit(prefix), (F.col("user_id") % kinds).cast("string")),
        source,
        F.lit("extra"),
    )
    # Signups become lines with too few fields.
    line = F.when(F.col("event_type") == "signup", F.array_join(F.slice(fields, 1, 2), "\t"))
    lines = table(spark, sf, "events").orderBy("event_id").select(
        F.coalesce(line, F.array_join(fields, "\t")).alias("value")
    )
    return _text_file(lines, "aliases")


@query(
    "S2 A16 Q21",
    _resolved_sql("'A' || (user_id % 3)"),
)
def alias_file_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_ids(readers.read_aliases(spark, _alias_file(spark, sf)))


@query(
    "S3 P10 J6 Q21",
    """SELECT x.n_name AS uniprot_a, y.n_name AS uniprot_b, s AS combined_score
       FROM (SELECT user_id % 30 AS a, event_id % 30 AS b, CAST(floor(value * 10) AS INTEGER) AS s FROM events)
       JOIN nation x ON x.n_nationkey = a JOIN nation y ON y.n_nationkey = b WHERE s >= 700""",
)
def edge_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "events").select(
        F.concat_ws(
            "  ",
            (F.col("user_id") % 30).cast("string"),
            (F.col("event_id") % 30).cast("string"),
            F.floor(F.col("value") * 10).cast("string"),
        ).alias("value")
    )
    edges = readers.read_edges(spark, _text_file(lines, "edges"), min_score=700, partitions=8)
    mapping = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("accession")
    )
    return resolve_edges(edges, mapping)[0]


_EDGES = """
    SELECT 'E' || (l_orderkey % 2000) AS a, 'E' || (l_partkey % 2000) AS b,
           CAST(l_quantity * 20 AS INTEGER) AS s
    FROM lineitem WHERE l_quantity * 20 >= 700"""


def _interaction_files(spark: SparkSession, sf: str) -> tuple[str, str]:
    """An alias file whose aliases are keys of parts, and an edge file between its ids."""
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws(
            " ",
            F.concat(F.lit("E"), (F.col("l_orderkey") % 2000).cast("string")),
            F.concat(F.lit("E"), (F.col("l_partkey") % 2000).cast("string")),
            (F.col("l_quantity") * 20).cast("int").cast("string"),
        ).alias("value")
    )
    return _alias_file(spark, sf, "P", 250), _text_file(lines, "edges")


@query(
    "Q21 S2 S3 J6 A16 A17",
    f"""WITH m AS ({_resolved_sql("'P' || (user_id % 250)")}), e AS ({_EDGES}),
             j AS (SELECT x.accession AS uniprot_a, y.accession AS uniprot_b, s AS combined_score
                   FROM e LEFT JOIN m x ON x.id = a LEFT JOIN m y ON y.id = b)
        SELECT *, (SELECT count(*) FROM j WHERE uniprot_a IS NULL OR uniprot_b IS NULL) AS unmapped
        FROM j WHERE uniprot_a IS NOT NULL AND uniprot_b IS NOT NULL""",
)
def ingest_interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Alias file and edge file to the written bronze relation, with the unmapped count."""
    aliases, edges = _interaction_files(spark, sf)
    path = scratch_path(spark, "bronze-string")
    done = ingest.ingest_interactions(spark, aliases, edges, path, partitions=8)
    again = ingest.ingest_interactions(spark, aliases, edges, path)
    assert done.written and not again.written and done.rows == again.rows
    return storage.read_parquet(spark, path).withColumn(
        "unmapped", F.lit(again.unmapped).cast("long")
    )


@query(
    "Q5 Q21 S1 P10 P11",
    f"""WITH m AS ({_resolved_sql("'P' || (user_id % 250)")}), e AS ({_EDGES}),
             j AS (SELECT x.accession AS a, y.accession AS b, s
                   FROM e JOIN m x ON x.id = a JOIN m y ON y.id = b)
        SELECT least(a, b) AS uniprot_a, greatest(a, b) AS uniprot_b, max(s) AS combined_score
        FROM j WHERE a <> b AND a IN (SELECT 'P' || p_partkey FROM part)
            AND b IN (SELECT 'P' || p_partkey FROM part)
        GROUP BY 1, 2""",
)
def landed_to_fact_interaction(spark: SparkSession, sf: str) -> DataFrame:
    """Landed entries, alias file and edge file to bronze, and the star's fact from there."""
    aliases, edges = _interaction_files(spark, sf)
    landed = scratch_path(spark, "entries")
    _entries(spark, sf).write.json(landed, compression="gzip")
    root = scratch_path(spark, "bronze")
    paths = storage.bronze_paths(root)
    ingest.ingest_entries(spark, landed, paths["uniprot"])
    ingest.ingest_interactions(spark, aliases, edges, paths["string"], partitions=8)
    editorial = spark.createDataFrame([], schemas.SEED_EDITORIAL)
    return build_star(spark, load_bronze(spark, root), editorial)["fact_interaction"]


@query(
    "J6",
    """SELECT n_name AS uniprot_a, n_name AS uniprot_b, count(*) AS edges FROM (
           SELECT user_id % 30 AS k FROM events UNION ALL SELECT event_id % 30 FROM events)
       JOIN nation ON n_nationkey = k GROUP BY n_name""",
)
def edge_resolve_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Two resolved edge sets in one plan."""
    mapping = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("accession")
    )
    events = table(spark, sf, "events")

    def resolved(column: str) -> DataFrame:
        end = (F.col(column) % 30).cast("string")
        edges = events.select(
            end.alias("protein1"), end.alias("protein2"), F.lit(900).alias("combined_score")
        )
        return resolve_edges(edges, mapping)[0]

    both = resolved("user_id").unionByName(resolved("event_id"))
    return both.groupBy("uniprot_a", "uniprot_b").agg(F.count(F.lit(1)).alias("edges"))


@query(
    "S4 A14",
    """SELECT p_name AS gene_symbol, CASE WHEN p_type <> 'PROMO' THEN p_brand END AS uniprot_accession,
              nullif(p_type, 'ECONOMY') AS protein_class, 'S' || p_size AS rna_tissue_specificity,
              CAST(NULL AS VARCHAR) AS rna_tissue_distribution, p_brand AS subcellular_location,
              p_type AS disease_involvement
       FROM part
       QUALIFY row_number() OVER (
           PARTITION BY CASE WHEN p_type <> 'PROMO' THEN p_brand END ORDER BY p_partkey) = 1""",
)
def tsv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Brands as keys: many rows per key, one NULL key, and the first line of the files wins."""
    rows = table(spark, sf, "part").orderBy("p_partkey").select(
        F.col("p_size").alias("Extra"),
        F.col("p_name").alias("Gene"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("Uniprot"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).otherwise("NA").alias("Protein class"),
        F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("RNA tissue specificity"),
        F.lit(None).cast("string").alias("RNA tissue distribution"),
        F.col("p_brand").alias("Subcellular location"),
        F.col("p_type").alias("Disease involvement"),
    )
    path = scratch_path(spark, "annotations")
    rows.write.csv(path, sep="\t", header=True, nullValue="")
    scanned = readers.read_tsv(spark, path, schemas.HPA_COLUMNS)
    return keep_first(scanned, ["uniprot_accession"], readers.ORD).drop(readers.ORD)


@query(
    "S5 U2",
    "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents",
)
def parts_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parts")
    table(spark, sf, "documents").repartition(6, "doc_id").write.parquet(path)
    rows = readers.read_parts(spark, path, ["doc_id", "lang", "source", "text"])
    return rows.select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@query(
    "S5 U2",
    "SELECT doc_id, lang, source FROM documents",
)
def parts_with_other_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that hold the declared columns beside others of their own, in another order."""
    path = scratch_path(spark, "parts")
    documents = table(spark, sf, "documents")
    odd = F.col("doc_id") % 2 == 1
    documents.where(odd).select("source", "n_chars", "doc_id", "lang").write.parquet(path)
    documents.where(~odd).select("doc_id", "lang", "source", "text").write.mode("append").parquet(path)
    return readers.read_parts(spark, path, ["doc_id", "lang", "source"])


@query(
    "S6 S7 S8 S9",
    """SELECT l_returnflag, count(*) AS lines, sum(l_quantity) AS quantity,
              (SELECT count(*) FROM lineitem) AS rows_first, (SELECT count(*) FROM lineitem) AS rows_second,
              true AS first_written, false AS second_written
       FROM lineitem GROUP BY l_returnflag""",
)
def roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write a versioned relation, skip the second write, read it back with its manifest."""
    root = scratch_path(spark, "relations")
    path = storage.versioned_path(root, "lines", "1.0", "lineitem")
    first, wrote = storage.materialize(spark, path, lambda: table(spark, sf, "lineitem"))
    second, again = storage.materialize(spark, path, lambda: table(spark, sf, "lineitem"))
    storage.write_manifest(spark, f"{path}.manifest", relation="lineitem", rows_first=first)
    manifest = storage.read_manifest(spark, f"{path}.manifest")
    return (
        storage.read_parquet(spark, path)
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
        .withColumn("rows_first", manifest.select(F.col("rows_first").cast("long")).scalar())
        .withColumn("rows_second", F.lit(second).cast("long"))
        .withColumn("first_written", F.lit(wrote))
        .withColumn("second_written", F.lit(again))
    )


@query(
    "S11",
    """SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS top_price
       FROM orders GROUP BY o_orderstatus""",
)
def table_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk load into a table, the second load replacing the first, the third built from it."""
    path = scratch_path(spark, "orders")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    storage.replace_table(orders.withColumn("load", F.lit(1)), name, path)
    storage.replace_table(orders, name, path)
    storage.replace_table(spark.table(name), name, path)
    return (
        spark.table(name)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("top_price"))
    )


@query(
    "S10 F2",
    """SELECT r_name, count(*) AS customers FROM customer
       JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""",
)
def source_views(spark: SparkSession, sf: str) -> DataFrame:
    names = ("customer", "nation", "region")
    storage.register_views(spark, {n: f"{sf}/{n}.parquet" for n in names}, prefix="landed_")
    return spark.sql(
        """SELECT r_name, count(*) AS customers FROM landed_customer
           JOIN landed_nation ON n_nationkey = c_nationkey
           JOIN landed_region ON r_regionkey = n_regionkey GROUP BY r_name"""
    )


@query(
    "S12",
    """SELECT 'K' || p_partkey AS protein_class_token, p_type || ', "' || p_name || '"' AS family_group,
              CASE WHEN p_size > 5 THEN p_size END AS priority FROM part""",
)
def seed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Quoted commas and quotes in a text field, a trailing field that may be empty."""
    quoted = F.concat(F.col("p_type"), F.lit(', "'), F.col("p_name"), F.lit('"'))
    rows = table(spark, sf, "part").select(
        _key("K").alias("protein_class_token"),
        quoted.alias("family_group"),
        F.when(F.col("p_size") > 5, F.col("p_size")).alias("priority"),
    )
    path = scratch_path(spark, "seed")
    rows.write.csv(path, header=True, quote='"', escape='"')
    return readers.read_seed(spark, path, schemas.SEED_FAMILY_GROUPS)


_CURATED = """
    SELECT c_custkey, 'Brand#' || (c_custkey % 30) AS symbol, c_name AS tagline, c_mktsegment AS text
    FROM customer"""


def _curation(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as table rows of a markdown file, among headings, rules and short rows."""
    symbol = F.concat(F.lit("Brand#"), (F.col("c_custkey") % 30).cast("string"))
    row = F.concat(
        F.lit(" | "), symbol, F.lit(" |  "), F.col("c_name"), F.lit(" | "), F.col("c_mktsegment"), F.lit(" |")
    )
    lines = table(spark, sf, "customer").select(
        F.explode(
            F.array(
                F.lit("| Gene | Tagline | Text |"),
                F.lit("|---|---|---|"),
                row,
                F.lit("| two | cells |"),
                F.concat(F.lit("About "), F.col("c_name")),
            )
        ).alias("value")
    )
    return readers.read_pipe_table(spark, _text_file(lines, "curation", "none")).drop(readers.ORD)


@query("S14", f"SELECT symbol, tagline, text FROM ({_CURATED})")
def pipe_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _curation(spark, sf)


@query(
    "Q20 S14 J15",
    f"""SELECT acc AS uniprot_accession, tagline, text AS function_friendly, true AS is_curated
        FROM ({_CURATED})
        JOIN (SELECT p_brand, min('P' || p_partkey) AS acc FROM part GROUP BY 1) ON p_brand = symbol""",
)
def editorial_seed(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "part").select(
        F.col("p_brand").alias("gene_symbol"), _key("P").alias("uniprot_accession")
    )
    return build_editorial_seed(match_symbols(_curation(spark, sf), dim)[0])
