"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured shuffle sizes: it broadcasts a side only when its
# real size is under the threshold and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    app: str = "keystar",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """``shuffle_partitions`` is where AQE starts merging from: the shuffled bytes of the largest
    stage over what fits in a task, some thousands for many TB."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {}
    if shuffle_partitions:
        sized["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    for key, value in {**DEFAULTS, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own: on a
    cluster a machine-local folder would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="keystar-")
    spark.sparkContext.setCheckpointDir(root)
    return root


# The folder of the run that is open, if any.
_run: ContextVar[str | None] = ContextVar("scratch_run", default=None)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder for everything that is stashed inside, removed at the end.

    What is computed inside has to be written elsewhere before the run ends. Without a run,
    stashed relations stay until the owner of the scratch folder removes them.
    """
    folder = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder below the scratch folder that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder; never reused, so no run sees another's files."""
    return f"{_run.get() or scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's own setting; it removes a write's shuffle files as soon as the write is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside drop their own shuffle files when they are done."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stash(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the scratch folder, or a folder below it, and read it back.

    Cuts the lineage, computes the input a single time and lets later readers fetch only
    the columns they need; the files outlive any executor. Its shuffles, which nothing reads
    again, go with the write.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
