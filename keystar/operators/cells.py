"""Search by new vectors over an index of cells.

Directions are grouped into cells around centroids; the index is a written table, partitioned by
cell, that holds every vector. A search reads the cells whose centroids are nearest to a query
and ranks what they hold by exact similarity; with all cells it is the exact search.

The tasks are a grid of groups of cells and strips of queries, both as large as a task can hold:
a query travels once to each group that has a cell of its own, not once to each cell, and a
vector once to each strip.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystar import constants as K
from keystar.functions.vectors import has_direction
from keystar.operators.embedding import ModelFactory, embed
from keystar.operators.neighbors import SCALE, STRIP_BYTES, Best, apart, strip_topk, units_of
from keystar.operators.ranking import top_n
from keystar.session import scratch_path, shuffles_removed, stash

#: Vectors the centroids are fitted on, chosen by a hash of their id; every vector is indexed.
SAMPLE_ROWS = 65_536
#: Bounds the centroids, which go to every task.
MOST_CELLS = 4096
ITERATIONS = 12
#: Vectors of a group that one task holds at most; a larger cell lies in several groups.
BLOCK_ROWS = 500_000
#: Queries that are compared with a cell at a time, and rows whose cells are found at a time.
QUERY_ROWS = 1024


@dataclass(frozen=True)
class CellIndex:
    """A written index: where it is, its centroids, the rows of each cell and the type of its ids."""

    path: str
    centroids: np.ndarray
    sizes: np.ndarray
    id_type: T.DataType

    def rows(self, spark: SparkSession) -> DataFrame:
        """(id, vector, cell) of every indexed vector."""
        return spark.read.parquet(self.path)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & has_direction(vector), F.lit(False))


def fit_centroids(units: DataFrame, cells: int, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Directions of at most ``cells`` cells, by spherical k-means on a bounded sample.

    The sample is the ``sample_rows`` rows (id, unit) with the least hash of their id: the same
    rows on every run, however the table is laid out. Their lengths do not matter.
    """
    chosen = units.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("unit")
    x = units_of(chosen.toArrow().column("unit").combine_chunks())
    if not len(x):
        return np.zeros((0, 0))
    centroids = x[: min(cells, len(x))]
    for _ in range(ITERATIONS):
        own = np.concatenate([(x[i : i + 4096] @ centroids.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        length = np.linalg.norm(sums, axis=1)
        # An empty cell stays where it is.
        centroids = np.where(length[:, None] > 0, sums / np.maximum(length, 1e-300)[:, None], centroids)
    return centroids


def _nearest(units: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest centroids of each row, nearest first."""
    found = np.zeros((len(units), probes), dtype=np.int32)
    for i in range(0, len(units), QUERY_ROWS):
        scores = units[i : i + QUERY_ROWS] @ centroids.T
        if probes == 1:
            found[i : i + QUERY_ROWS, 0] = scores.argmax(axis=1)
        else:
            found[i : i + QUERY_ROWS] = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
    return found


def nearest_cells(df: DataFrame, vector: str, centroids: np.ndarray, probes: int) -> DataFrame:
    """``df`` with the list ``cells`` of the ``probes`` nearest centroids, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _nearest(units_of(batch.column(vector)), centroids, probes)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists], names=[*batch.schema.names, "cells"]
            )

    schema = T.StructType([*df.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def build_index(
    df: DataFrame,
    id: str,
    vector: str,
    cells: int | None = None,
    path: str | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> CellIndex:
    """Writes every vector with a direction to its cell and returns the index.

    By default there are about as many cells as the root of the rows, at most ``MOST_CELLS``.
    Vectors of another length than most cannot be indexed and raise an error. A cell has one
    file, or several if it is much larger than others.
    """
    spark = df.sparkSession
    rows = df.where(_usable(F.col(vector))).select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    lengths = rows.agg(
        F.count("*").alias("n"), F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")
    ).first()
    if lengths["low"] != lengths["high"]:
        raise ValueError(f"vectors of {lengths['low']} to {lengths['high']} components")
    wanted = cells or min(MOST_CELLS, max(1, math.isqrt(lengths["n"])))
    centroids = fit_centroids(rows.withColumnRenamed("vector", "unit"), wanted, sample_rows)
    path = path or scratch_path(spark, "cells")
    placed = nearest_cells(rows, "vector", centroids, 1).select(
        "id", "vector", F.get("cells", F.lit(0)).alias("cell")
    )
    with shuffles_removed(spark):
        # Spark splits what turns out to be large, so a hot cell does not land in one task.
        placed.hint("rebalance", F.col("cell")).write.partitionBy("cell").parquet(path)
    sizes = np.zeros(len(centroids), dtype=np.int64)
    if len(sizes):
        counted = spark.read.parquet(path).groupBy("cell").count().toArrow()
        sizes[counted.column("cell").to_numpy()] = counted.column("count").to_numpy()
    return CellIndex(path, centroids, sizes, rows.schema["id"].dataType)


def _grid(rows: int, queries: int, dim: int, cores: int) -> tuple[int, int]:
    """Rows of a group and number of query strips: what fits, two tasks for every core, little copied."""
    most = max(1, min(BLOCK_ROWS, STRIP_BYTES // (8 * max(1, dim))))
    even = round(math.sqrt(2 * cores * queries / max(1, rows)))
    strips = max(1, -(-queries // most), even)
    groups = max(1, -(-rows // most), -(-2 * cores // strips))
    return max(1, -(-rows // groups)), strips


def _groups(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """First group and number of groups of each cell, and the cells of each group.

    Cells are gathered until a group has ``most`` rows; a larger cell has groups of its own.
    """
    first, parts = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64)
    members: list[list[int]] = []
    room = 0
    for cell, size in enumerate(sizes.tolist()):
        if size > most:
            parts[cell] = -(-size // most)
            first[cell] = len(members)
            members += [[cell] for _ in range(parts[cell])]
            room = 0
            continue
        if not members or size > room:
            members.append([])
            room = most
        members[-1].append(cell)
        first[cell] = len(members) - 1
        room -= size
    return first, parts, [np.array(x) for x in members]


def _asking(
    asked: DataFrame, centroids: np.ndarray, probes: int, members: list[np.ndarray]
) -> DataFrame:
    """The queries once per group that has a cell they ask for, with those cells as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, QUERY_ROWS):
                batch = whole.slice(at, QUERY_ROWS)
                wanted = np.zeros((batch.num_rows, len(centroids)), dtype=bool)
                found = _nearest(units_of(batch.column("vector")), centroids, probes)
                np.put_along_axis(wanted, found, True, axis=1)
                for group, cells in enumerate(members):
                    mine = wanted[:, cells]
                    some = np.flatnonzero(mine.any(axis=1))
                    if len(some):
                        bits = pa.array([x.tobytes() for x in np.packbits(mine[some], axis=1)], pa.binary())
                        numbers = pa.array(np.full(len(some), group, dtype=np.int64))
                        part = batch.take(pa.array(some))
                        yield pa.RecordBatch.from_arrays(
                            [*part.columns, numbers, bits], names=[*part.schema.names, "cell_group", "bits"]
                        )

    return asked.mapInArrow(
        run, T.StructType([*asked.schema.fields, T.StructField("cell_group", T.LongType()), T.StructField("bits", T.BinaryType())])
    )


def _compare(
    many: DataFrame, asked: DataFrame, k: int, tiles: int, members: list[np.ndarray] | None, strips: int, schema: T.StructType
) -> DataFrame:
    """Best k of every group and strip that meet, as (query_id, id, similarity).

    ``members`` has the cells of each group; without it every query meets every row.
    """

    def compare(names: tuple, many: pa.Table, queries: pa.Table) -> pa.Table:
        target = pa.schema([("query_id", queries.schema.field("query_id").type),
                            ("id", many.schema.field("id").type), ("similarity", pa.float64())])
        if not many.num_rows or not queries.num_rows:
            return target.empty_table()
        many = many.sort_by("id")
        right = units_of(many.column("vector").combine_chunks())
        left = units_of(queries.column("vector").combine_chunks())
        if members is None:
            row, at, score = strip_topk(left, right, k)
        else:
            row, at, score = _by_cell(left, right, many, queries, members[names[0].as_py() // strips], k)
        return pa.table(
            [
                queries.column("query_id").take(pa.array(row)),
                many.column("id").take(pa.array(at)),
                pa.array(score / SCALE),
            ],
            schema=target,
        )

    return (
        apart(many, "tile", tiles)
        .groupBy("tile")
        .cogroup(apart(asked, "tile", tiles).groupBy("tile"))
        .applyInArrow(compare, schema)
    )


def _by_cell(
    left: np.ndarray, right: np.ndarray, many: pa.Table, queries: pa.Table, cells: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lists of queries that meet only the cells they ask for."""
    bits = np.frombuffer(b"".join(queries.column("bits").to_pylist()), dtype=np.uint8)
    wanted = np.unpackbits(bits.reshape(len(left), -1), axis=1, count=len(cells)).astype(bool)
    own = many.column("cell").to_numpy()
    # By cell, in the order of ids within it; ties between cells go by that order too.
    order = np.argsort(own, kind="stable")
    places = np.searchsorted(own[order], cells, "left"), np.searchsorted(own[order], cells, "right")
    best = Best(len(left), k, ordered=False)
    for number, (low, high) in enumerate(zip(*places, strict=True)):
        asking = np.flatnonzero(wanted[:, number])
        for at in range(low, high, QUERY_ROWS):
            rows = order[at : min(at + QUERY_ROWS, high)]
            units = right[rows]
            narrow = units.astype(np.float32).T
            for i in range(0, len(asking), QUERY_ROWS):
                some = asking[i : i + QUERY_ROWS]
                best.take(left[some].astype(np.float32) @ narrow, left, right, some, rows)
    return best.lists()


def search(
    index: CellIndex,
    queries: DataFrame,
    id: str,
    vector: str,
    k: int = K.NEIGHBOR_K,
    probes: int | None = None,
) -> DataFrame:
    """(query_id, id, similarity, rank 1..k) of the best vectors in the ``probes`` nearest cells.

    Without ``probes`` all cells are read and the result is exact. Similarity is rounded to six
    decimals, ties go to the smaller id. Queries without a direction find nothing; a query is
    not left out of its own list if it was indexed.
    """
    spark = queries.sparkSession
    cells = len(index.centroids)
    asked = queries.where(_usable(F.col(vector))).select(
        F.col(id).alias("query_id"), F.col(vector).alias("vector")
    )
    schema = T.StructType(
        [
            asked.schema["query_id"],
            T.StructField("id", index.id_type),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    if not cells:
        return spark.createDataFrame([], schema).withColumn("rank", F.lit(0))
    # Counting and dealing read the queries, so they are written once.
    asked = stash(asked, "asked")
    probes = min(probes or cells, cells)
    cores = spark.sparkContext.defaultParallelism
    most, strips = _grid(int(index.sizes.sum()), asked.count(), index.centroids.shape[1], cores)
    own = F.pmod(F.xxhash64("query_id"), F.lit(strips))
    if probes == cells:
        members = None
        groups = -(-int(index.sizes.sum()) // most)
        many = index.rows(spark).withColumn("cell_group", F.pmod(F.xxhash64("id"), F.lit(groups)))
        asking = asked.withColumn("cell_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    else:
        first, parts, members = _groups(index.sizes, most)
        groups = len(members)
        # No more numbers than there are cells; the files of other cells are not read.
        nearest = nearest_cells(asked, "vector", index.centroids, probes)
        wanted = [r[0] for r in nearest.select(F.explode("cells").alias("cell")).distinct().collect()]
        read = index.rows(spark)
        if len(wanted) < cells:
            read = read.where(F.col("cell").isin(wanted))
        part = F.pmod(F.xxhash64("id"), F.get(F.lit(parts), F.col("cell")))
        many = read.withColumn("cell_group", F.get(F.lit(first), F.col("cell")) + part)
        asking = _asking(asked, index.centroids, probes, members)
    every = F.explode(F.sequence(F.lit(0), F.lit(strips - 1)))
    many = many.withColumn("strip", every).select(
        "id", "vector", "cell", (F.col("cell_group") * strips + F.col("strip")).cast("int").alias("tile")
    )
    asking = asking.withColumn("tile", (F.col("cell_group") * strips + own).cast("int")).drop("cell_group")
    best = _compare(many, asking, k, groups * strips, members, strips, schema)
    return top_n(best, "query_id", k, F.desc("similarity"), F.asc("id"))


def search_texts(
    index: CellIndex,
    texts: DataFrame,
    id: str,
    text: str,
    model_factory: ModelFactory,
    k: int = K.NEIGHBOR_K,
    probes: int | None = None,
) -> DataFrame:
    """The same for new texts, which the model that made the index embeds first."""
    asked = embed(texts.select(id, text), text, model_factory)
    return search(index, asked, id, "embedding", k, probes)
