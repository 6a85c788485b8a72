"""Relations stored in buckets of their key, of which a refresh rewrites only the touched ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar.session import remove, stash

BUCKET = "key_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def write_keyed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """All rows below ``path``, one folder per bucket of ``keys``."""
    rows = df.select("*", bucket_of(keys, buckets)).repartition(buckets, BUCKET)
    rows.write.partitionBy(BUCKET).parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def replace_keys(
    spark: SparkSession,
    path: str,
    keys: list[str],
    buckets: int,
    affected: DataFrame,
    recomputed: DataFrame,
) -> list[int]:
    """The rows of the ``affected`` keys are replaced by ``recomputed``; the rewritten buckets.

    Keys without recomputed rows go. Buckets without an affected key keep their files. A bucket
    is replaced when its new files are complete; a run that breaks off is repeated from the
    same versions and ends in the same state.
    """
    stored = spark.read.parquet(path)
    names = affected.select(*keys).distinct()
    # The bucket numbers are at most as many as there are buckets.
    touched = sorted(r[0] for r in names.select(bucket_of(keys, buckets)).distinct().collect())
    if not touched:
        return []
    kept = stored.where(F.col(BUCKET).isin(touched)).join(names, keys, "left_anti")
    fresh = recomputed.join(names, keys, "left_semi").select("*", bucket_of(keys, buckets))
    rows = stash(kept.unionByName(fresh.select(*kept.columns)), "buckets")
    left = {r[0] for r in rows.select(BUCKET).distinct().collect()}
    (
        rows.repartition(len(touched), BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )
    for number in touched:
        if number not in left:
            remove(spark, f"{path.rstrip('/')}/{BUCKET}={number}")
    return touched
