"""Scans over landed files.

"First wins" rules need the order of the file. ``file_order`` captures it on the scan
itself, before any shuffle: file, start of the split, position within the split.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystar import schemas
from keystar.functions.lists import distinct_texts, first_element, first_where, has_text, or_empty
from keystar.functions.texts import null_tokens

ORD = "ord"
# Part footers read at once.
FOOTERS = 8


def file_order() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"),
    )


def spread(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal out the rows of a scan over ``partitions`` tasks, ahead of heavy per-row work.

    For files that cannot be split or hold a single block, which the caller knows; without a
    number the scan is returned as it is.
    """
    return scan.repartition(partitions) if partitions else scan


def read_entries(spark: SparkSession, path: str, paged: bool = False) -> DataFrame:
    """Nested JSON entries flattened to the 11 bronze columns.

    ``paged`` files hold one document each, with the entries under ``results``. A line that is
    not JSON and an entry without its key are errors, whichever columns are read.
    """
    if paged:
        pages = spark.read.schema(schemas.ENTRY_PAGE).json(path, multiLine=True)
        entries = pages.select(F.explode("results").alias("e")).select("e.*")
    else:
        entries = spark.read.schema(schemas.ENTRY).json(path)
    return flatten_entries(entries)


def flatten_entries(entries: DataFrame) -> DataFrame:
    description = F.col("proteinDescription")
    function = first_where(F.col("comments"), lambda c: c["commentType"] == "FUNCTION")
    xrefs = F.col("uniProtKBCrossReferences")

    def ids_of(database: str) -> Column:
        return distinct_texts(
            F.transform(F.filter(xrefs, lambda x: x["database"] == database), lambda x: x["id"])
        )

    def gene_ids(xref: Column) -> Column:
        hits = F.filter(
            xref["properties"], lambda p: (p["key"] == "GeneId") & has_text(p["value"])
        )
        return or_empty(F.transform(hits, lambda p: p["value"]))

    ensembl = F.filter(xrefs, lambda x: x["database"] == "Ensembl")
    # A filter, since an unread column would take its check with it.
    stop = F.raise_error(F.lit("entry without primaryAccession")).cast("boolean")
    keyed = F.when(F.col("primaryAccession").isNotNull(), True).otherwise(stop)
    return entries.where(keyed).select(
        F.col("primaryAccession").alias("primary_accession"),
        or_empty(F.col("secondaryAccessions")).alias("secondary_accessions"),
        first_element(F.col("genes"))["geneName"]["value"].alias("gene_symbol"),
        F.coalesce(
            description["recommendedName"]["fullName"]["value"],
            first_element(description["submissionNames"])["fullName"]["value"],
        ).alias("protein_name"),
        F.col("sequence.length").alias("sequence_length"),
        F.col("sequence.value").alias("sequence"),
        first_element(function["texts"])["value"].alias("function_raw"),
        F.filter(
            or_empty(F.transform("keywords", lambda k: k["name"])), has_text
        ).alias("keywords"),
        ids_of("Pfam").alias("pfam_ids"),
        distinct_texts(F.flatten(F.transform(ensembl, gene_ids))).alias("ensembl_gene_ids"),
        ids_of("STRING").alias("string_ids"),
    )


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(string_protein_id, alias, source, ord); lines with fewer than three fields are dropped."""
    fields = F.split("value", "\t")
    lines = spark.read.text(path).select("value", file_order().alias(ORD))
    return lines.where((F.size(fields) >= 3) & ~F.col("value").startswith("#")).select(
        *(fields[i].alias(c) for i, c in enumerate(schemas.ALIASES.names)), ORD
    )


def read_edges(
    spark: SparkSession, path: str, min_score: int, partitions: int | None = None
) -> DataFrame:
    """(protein1, protein2, combined_score) of a whitespace-delimited edge list.

    The score is checked while reading. A ``.gz`` file is one task; ``partitions``
    spreads its surviving rows before heavier work.
    """
    fields = F.split(F.btrim("value", F.lit(" \t\r\n")), r"\s+")
    score = F.when(F.get(fields, F.lit(2)) != "combined_score", F.get(fields, F.lit(2)).cast("int"))
    edges = (
        spark.read.text(path)
        .select(
            F.get(fields, F.lit(0)).alias("protein1"),
            F.get(fields, F.lit(1)).alias("protein2"),
            score.alias("combined_score"),
        )
        .where(F.col("combined_score") >= min_score)
    )
    return edges.repartition(partitions) if partitions else edges


def read_tsv(
    spark: SparkSession,
    path: str,
    columns: dict[str, str],
    nulls: tuple[str, ...] = ("", "NA"),
) -> DataFrame:
    """Chosen columns of a headed TSV, all text, with ``ord``.

    An absent column is an error, and so is a file whose header differs from the first one's.
    """
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False, enforceSchema=False)
    return raw.select(
        *(null_tokens(F.col(f"`{src}`"), nulls).alias(dst) for src, dst in columns.items()),
        file_order().alias(ORD),
    )


def read_parts(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Declared columns of a one- or many-file Parquet dataset; no file or column -> error.

    Every part has to hold every column; other columns may differ from part to part. Footers
    are read side by side, a few at a time.
    """
    parts = spark.read.parquet(path)

    def lacking(part: str) -> list[str]:
        held = spark.read.parquet(part).columns
        return [f"{part}: no column {c}" for c in columns if c not in held]

    with ThreadPoolExecutor(FOOTERS) as pool:
        found = [line for lines in pool.map(lacking, parts.inputFiles()) for line in lines]
    if found:
        raise ValueError("; ".join(found))
    return parts.select(*columns)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV with quoted text; an empty trailing field is NULL."""
    return spark.read.csv(
        path, schema=schema, header=True, quote='"', escape='"', multiLine=True, enforceSchema=False
    )


def read_pipe_table(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, tagline, text, ord) rows of the pipe tables in a markdown file."""
    line = F.btrim("value", F.lit(" \t\r\n"))
    cells = F.split("line", r"\|")
    # The outer pipes leave an empty cell on each side, so three cells need five pieces.
    rows = (
        spark.read.text(path)
        .select(line.alias("line"), file_order().alias(ORD))
        .where(F.col("line").startswith("|") & F.col("line").endswith("|") & (F.size(cells) >= 5))
        .select(
            *(F.btrim(cells[i], F.lit(" \t")).alias(c) for i, c in
              ((1, "symbol"), (2, "tagline"), (3, "text"))),
            ORD,
        )
    )
    return rows.where(
        (F.col("symbol") != "") & (F.col("symbol") != "Gene") & ~F.col("symbol").startswith("-")
    )
