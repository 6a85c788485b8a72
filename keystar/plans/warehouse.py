"""Building the whole star, in memory or as versioned relations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from keystar import schemas
from keystar.operators.embedding import ModelFactory
from keystar.operators.quality import schema_differences
from keystar.plans.accessions import resolve_accessions, with_current_accessions
from keystar.plans.marts import ANCHOR, amino_acids, build_marts, family_groups
from keystar.plans.staging import build_staging
from keystar.plans.tables import Tables
from keystar.plans.vectors import fact_embedding, fact_protein_neighbor
from keystar.session import stash
from keystar.sources.storage import bronze_paths, read_parquet, replace_table


def build_star(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    editorial: DataFrame,
    residues: DataFrame | None = None,
    groups: DataFrame | None = None,
    model: tuple[ModelFactory, str] | None = None,
    terms: DataFrame | None = None,
    forwards: DataFrame | None = None,
) -> Tables:
    """Staging relations, marts and seeds by name; nothing is planned before it is asked for.

    With a ``model`` (batch function factory and version) the embedding and neighbour facts are
    among the marts; with the ontology's ``terms`` (efo_id, parents) diseases get their area;
    with ``forwards`` (old, new accession) old accessions are resolved before anything joins.
    """
    seeds = Tables(
        {
            "seed_amino_acids": lambda: amino_acids(spark) if residues is None else residues,
            "family_group_map": lambda: family_groups(spark) if groups is None else groups,
            "dim_protein_editorial": lambda: editorial,
        }
    )
    sources = seeds.extended(build_staging(bronze))
    if terms is not None:
        sources = sources.extended({"disease_terms": lambda: terms})
    if forwards is not None:
        resolution = stash(resolve_accessions(forwards, sources["stg_uniprot"]), "accessions")
        sources = with_current_accessions(sources, resolution)
    marts = sources.extended(build_marts(sources))
    if model is None:
        return marts
    embedded = marts.extended(
        {"fact_embedding": lambda: fact_embedding(marts["stg_uniprot"], *model)}
    )
    return embedded.extended(
        {"fact_protein_neighbor": lambda: fact_protein_neighbor(embedded["fact_embedding"])}
    )


def load_bronze(
    spark: SparkSession, root: str, versions: dict[str, str] | None = None
) -> Tables:
    return Tables(
        {
            name: (lambda path=path: read_parquet(spark, path))
            for name, path in bronze_paths(root, versions).items()
        }
    )


#: Columns by which single rows are read; each has bloom filters where it is stored.
LOOKED_UP = (
    ANCHOR, "gene_symbol", "ensembl_gene_id", "string_protein_id", "uniprot_a", "uniprot_b",
    "chembl_id", "efo_id",
)


def write_marts(
    star: Mapping[str, DataFrame], database: str | None = None, buckets: int | None = None
) -> list[str]:
    """Save seeds, dimensions and facts as tables (staging stays views); returns their names.

    A relation without its declared columns and types stops the run before it is written. With
    ``buckets`` every mart that has the anchor key is stored by it, which lets cards and map
    extracts read their sides already partitioned. Point reads skip row groups by range in the
    sorted key and by bloom filter in ``LOOKED_UP`` columns.
    """
    names = sorted(n for n in star if not n.startswith("stg_") and n != "disease_terms")
    tables = [f"{database}.{n}" if database else n for n in names]
    for name, table in zip(names, tables, strict=True):
        differences = schema_differences(star[name], schemas.MARTS[name])
        if differences:
            raise ValueError(f"{name}: {'; '.join(differences)}")
        mart = name.startswith(("dim_", "fact_")) and ANCHOR in star[name].columns
        looked_up = [c for c in LOOKED_UP if c in star[name].columns]
        key = ANCHOR if mart else None
        replace_table(star[name], table, key=key, buckets=buckets, looked_up=looked_up)
    return tables


def load_tables(spark: SparkSession, names: list[str]) -> Tables:
    """Saved tables as relations, by their unqualified names."""
    return Tables({n.rsplit(".", 1)[-1]: (lambda n=n: spark.table(n)) for n in names})
