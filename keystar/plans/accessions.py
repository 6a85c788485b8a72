"""Old accessions: what the base says they became, applied to staging before anything joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar.operators.graph import follow_forwards, forwarded, forwarded_unique
from keystar.plans.tables import Tables

# Staging relation -> its accession columns, and whether an accession names a row.
HOLDERS: dict[str, tuple[tuple[str, ...], bool]] = {
    "stg_hpa": (("uniprot_accession",), True),
    "stg_llm_rewrites": (("uniprot_accession",), True),
    "stg_string": (("uniprot_a", "uniprot_b"), False),
    "stg_ot_targets": (("uniprot_accession",), False),
}


def accession_links(bronze: DataFrame) -> DataFrame:
    """(old, new) of every secondary accession an entry lists."""
    return bronze.select(
        F.explode("secondary_accessions").alias("old"), F.col("primary_accession").alias("new")
    )


def resolve_accessions(links: DataFrame, base: DataFrame) -> DataFrame:
    return follow_forwards(links, base.select(F.col("uniprot_accession").alias("id")))


def ambiguous(resolution: DataFrame) -> DataFrame:
    """Old accessions that name no single current one, for review."""
    return resolution.where("status <> 'resolved'").select("id", "targets", "status")


def with_current_accessions(staging: Tables, resolution: DataFrame) -> Tables:
    """The same relations, with current accessions where an old one has a single successor."""

    def moved(name: str) -> DataFrame:
        columns, unique = HOLDERS[name]
        if unique:
            return forwarded_unique(staging[name], resolution, *columns)
        return forwarded(staging[name], resolution, *columns)

    return staging.extended({name: (lambda name=name: moved(name)) for name in HOLDERS})
