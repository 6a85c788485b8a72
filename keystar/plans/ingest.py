"""Landed files to bronze relations.

Each function reads one source, applies its rule and writes one versioned relation, unless a
finished one is there (``force`` writes it anew). ``ingest_all`` builds all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar import constants as K
from keystar import schemas
from keystar.operators.dedup import keep_first
from keystar.operators.quality import schema_differences
from keystar.operators.resolve import resolve_ids, unmapped, with_ends
from keystar.session import stash
from keystar.sources import readers
from keystar.sources.storage import bronze_paths, materialize, read_parquet, write_manifest

#: Bronze relations that are declared columns of a landed Parquet dataset.
DATASETS = ("ot_targets", "ot_diseases", "ot_associations", "ot_drugs", "ot_drug_molecules")


@dataclass(frozen=True)
class Landed:
    """Where the files of each source are; ``paged`` entries stand under ``results``."""

    entries: str
    aliases: str
    edges: str
    annotations: str
    datasets: dict[str, str]
    rewrites: str | None = None
    paged: bool = False


@dataclass(frozen=True)
class Ingested:
    rows: int
    written: bool
    unmapped: int | None = None


def _declared(df: DataFrame, relation: str) -> DataFrame:
    """Stop before anything is written that does not have the declared columns and types."""
    differences = schema_differences(df, schemas.BRONZE[relation])
    if differences:
        raise ValueError(f"{relation}: {'; '.join(differences)}")
    return df


def ingest_entries(
    spark: SparkSession, landed: str, path: str, paged: bool = False, force: bool = False
) -> Ingested:
    return Ingested(
        *materialize(
            spark,
            path,
            lambda: _declared(readers.read_entries(spark, landed, paged), "uniprot"),
            force,
        )
    )


def interactions(
    spark: SparkSession,
    aliases: str,
    edges: str,
    min_score: int = K.MIN_COMBINED_SCORE,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(resolved edges, one row ``kept, unmapped``) from an alias file and an edge file.

    Edges under the score go while the file is read. Both results read the looked-up ends,
    which are written once, so the count is exact whatever runs again.
    """
    mapping = resolve_ids(readers.read_aliases(spark, aliases))
    strong = readers.read_edges(spark, edges, min_score, partitions)
    ends = with_ends(strong, mapping, "protein1", "protein2")
    ends = stash(ends.select("end_a", "end_b", "combined_score"), "edge-ends")
    kept = ends.where(~unmapped()).select(
        F.col("end_a").alias("uniprot_a"), F.col("end_b").alias("uniprot_b"), "combined_score"
    )
    counts = ends.agg(
        F.count_if(~unmapped()).alias("kept"), F.count_if(unmapped()).alias("unmapped")
    )
    return kept, counts


def ingest_interactions(
    spark: SparkSession,
    aliases: str,
    edges: str,
    path: str,
    min_score: int = K.MIN_COMBINED_SCORE,
    partitions: int | None = None,
    force: bool = False,
) -> Ingested:
    """Alias file and edge file to bronze edges; the count of unmapped edges is kept beside them."""

    def build() -> DataFrame:
        kept, counts = interactions(spark, aliases, edges, min_score, partitions)
        seen = counts.first()
        write_manifest(spark, f"{path}.manifest", kept=seen["kept"], unmapped=seen["unmapped"])
        return _declared(kept, "string")

    rows, written = materialize(spark, path, build, force)
    manifest = spark.read.json(f"{path}.manifest").first()
    return Ingested(rows, written, int(manifest["unmapped"]))


def ingest_annotations(
    spark: SparkSession, landed: str, path: str, force: bool = False
) -> Ingested:
    """The first line of each key; lines without a key are one group."""

    def build() -> DataFrame:
        scanned = readers.read_tsv(spark, landed, schemas.HPA_COLUMNS)
        first = keep_first(scanned, ["uniprot_accession"], readers.ORD).drop(readers.ORD)
        return _declared(first, "hpa")

    return Ingested(*materialize(spark, path, build, force))


def ingest_dataset(
    spark: SparkSession, relation: str, landed: str, path: str, force: bool = False
) -> Ingested:
    """Declared columns of a many-part Parquet dataset."""

    def build() -> DataFrame:
        columns = schemas.BRONZE[relation].names
        return _declared(readers.read_parts(spark, landed, columns), relation)

    return Ingested(*materialize(spark, path, build, force))


def ingest_all(
    spark: SparkSession,
    landed: Landed,
    root: str,
    versions: dict[str, str] | None = None,
    partitions: int | None = None,
    force: bool = False,
) -> dict[str, Ingested]:
    """Every bronze relation below ``root``, where ``load_bronze`` finds them.

    Without landed rewrites that relation is written empty: nothing was rewritten yet.
    """
    paths = bronze_paths(root, versions)
    done = {
        "uniprot": ingest_entries(spark, landed.entries, paths["uniprot"], landed.paged, force),
        "string": ingest_interactions(
            spark, landed.aliases, landed.edges, paths["string"], partitions=partitions, force=force
        ),
        "hpa": ingest_annotations(spark, landed.annotations, paths["hpa"], force),
    }
    for name in DATASETS:
        done[name] = ingest_dataset(spark, name, landed.datasets[name], paths[name], force)

    def rewrites() -> DataFrame:
        if landed.rewrites is None:
            return spark.createDataFrame([], schemas.LLM_REWRITES)
        columns = schemas.LLM_REWRITES.names
        return _declared(read_parquet(spark, landed.rewrites).select(*columns), "llm_rewrites")

    done["llm_rewrites"] = Ingested(
        *materialize(spark, paths["llm_rewrites"], rewrites, force)
    )
    return done
