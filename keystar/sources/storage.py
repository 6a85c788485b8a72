"""Versioned Parquet relations, run manifests and views over them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar import constants as K
from keystar import schemas


def versioned_path(root: str, group: str, version: str, relation: str) -> str:
    return f"{root.rstrip('/')}/{group}/v{version}/{relation}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished relation is there; a write that was cut short does not count."""
    system, to = _filesystem(spark, path)
    return system.exists(to(f"{path}/_SUCCESS"))


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def write_parquet(df: DataFrame, path: str) -> None:
    """Write beside ``path``, then take its place: a failed write leaves what was there.

    The old files go only when the new ones are complete, so a relation may be replaced by
    something computed from itself.
    """
    path = path.rstrip("/")
    fresh = f"{path}.{uuid.uuid4().hex}"
    system, to = _filesystem(df.sparkSession, path)
    try:
        df.write.option("compression", "zstd").parquet(fresh)
    except Exception:
        system.delete(to(fresh), True)
        raise
    swap_in(df.sparkSession, fresh, path)


def swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the complete relation ``fresh`` where ``path`` is; the old one goes last."""
    system, to = _filesystem(spark, path)
    old = f"{path}.{uuid.uuid4().hex}"
    had = system.exists(to(path))
    if had and not system.rename(to(path), to(old)):
        raise OSError(f"cannot move {path}")
    if not system.rename(to(fresh), to(path)):
        if had:
            system.rename(to(old), to(path))
        raise OSError(f"cannot move {fresh}")
    if had:
        system.delete(to(old), True)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def count_rows(spark: SparkSession, path: str) -> int:
    """Row count from the Parquet footers."""
    return spark.read.parquet(path).count()


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False
) -> tuple[int, bool]:
    """Write ``build()`` to ``path`` unless it is already there; (rows, whether it was written)."""
    if not force and exists(spark, path):
        return count_rows(spark, path), False
    write_parquet(build(), path)
    return count_rows(spark, path), True


def bloom_options(columns: Iterable[str]) -> dict[str, str]:
    """Write options for a bloom filter per row group of each column.

    A look-up by a value then skips row groups whose range holds it but that do not have it.
    The size of a filter follows the distinct values of its row group.
    """
    named = {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns}
    return named | {"parquet.bloom.filter.adaptive.enabled": "true"} if named else {}


def replace_table(
    df: DataFrame,
    table: str,
    path: str | None = None,
    key: str | None = None,
    buckets: int | None = None,
    looked_up: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Create or replace a table in one bulk write, below ``path`` when one is given.

    The rows are written as a table of another name and location first, which then takes the
    name: a failed write leaves the old table, and it may be read to build the new one. With
    ``key`` and ``buckets`` the rows are stored by key, one sorted file per bucket, so joins and
    windows on the key read them without a shuffle. ``looked_up`` columns get bloom filters;
    ``options`` go to the writer.
    """
    bucketed = key is not None and buckets is not None
    load = uuid.uuid4().hex
    fresh = f"{table}__{load}"
    rows = df.repartition(buckets, key) if bucketed else df
    extra = {**bloom_options(looked_up), **(options or {})}
    writer = rows.write.option("compression", "zstd").options(**extra)
    if bucketed:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", f"{path.rstrip('/')}/{load}")
    spark = df.sparkSession
    try:
        writer.saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")


def write_manifest(spark: SparkSession, path: str, **fields: str) -> None:
    """One JSON row describing a run, kept beside its output."""
    stamped = {**fields, "written_at": datetime.now(UTC).isoformat()}
    row = spark.range(1).select(*(F.lit(str(v)).alias(k) for k, v in stamped.items()))
    row.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def bronze_paths(root: str, versions: dict[str, str] | None = None) -> dict[str, str]:
    chosen = {**K.VERSIONS, **(versions or {})}
    return {
        relation: versioned_path(root, group, chosen[group], relation)
        for relation, group in K.BRONZE_GROUP.items()
    }


def register_views(spark: SparkSession, paths: dict[str, str], prefix: str = "bronze_") -> None:
    """A temporary view over each landed Parquet relation."""
    for relation, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(f"{prefix}{relation}")


def empty_sources(spark: SparkSession) -> dict[str, DataFrame]:
    """Zero-row relations with the declared schemas, to build the whole star without data."""
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.BRONZE.items()}
