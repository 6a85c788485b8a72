"""Keyed maintenance of a materialised relation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar.sources.storage import count_rows, read_parquet, swap_in, write_parquet


def patch_by_key(old: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``patch`` in place of its own; write it to a new path."""
    kept = old.join(patch.select(key), key, "left_anti")
    return kept.unionByName(patch)


def apply_patch(spark: SparkSession, path: str, patch: DataFrame, key: str) -> int:
    """Patch the relation at ``path`` and return its row count.

    The merged rows are written once beside it; both counts come from the footers, and only an
    unchanged count lets the new version take the old one's place.
    """
    fresh = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    write_parquet(patch_by_key(read_parquet(spark, path), patch, key), fresh)
    before, after = count_rows(spark, path), count_rows(spark, fresh)
    if before != after:
        raise ValueError(f"row count changed by the patch: {before} -> {after}; see {fresh}")
    swap_in(spark, fresh, path.rstrip("/"))
    return after


def check_patch(old: DataFrame, merged: DataFrame) -> None:
    """Raise when a patch changed the row count (it held a key the relation lacks, or twice)."""
    before, after = old.count(), merged.count()
    if before != after:
        raise ValueError(f"row count changed by the patch: {before} -> {after}")


def member_check(result: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, found) for every expected member."""
    present = result.select(F.col(key).alias("_present")).distinct()
    return expected.select(key).distinct().join(
        present, F.col(key) == F.col("_present"), "left"
    ).select(key, F.col("_present").isNotNull().alias("found"))


def split_members(result: DataFrame, expected: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(found, missing) keys of ``expected``."""
    return (
        expected.select(key).join(result.select(key), key, "left_semi"),
        expected.select(key).join(result.select(key), key, "left_anti"),
    )
