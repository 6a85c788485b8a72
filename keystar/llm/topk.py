"""Exact top-k search: tiled matrix products, a selection per tile, a tree of merges.

Candidates and queries are packed into blocks of bounded size. A tile is one query block
against one candidate block: a matrix product in one task that keeps k rows per query. The
lists of neighbouring candidate blocks are merged first, then those of a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keystar.session import stash

SCALE = 256.0
QUERY_ROWS = 2048
CANDIDATE_ROWS = 8192
#: Candidate blocks whose lists meet in the first level of the merge.
FAN_IN = 64
#: Scores held at once inside a tile.
SCORES = 4_000_000

BLOCK = "block long, dim int, kind string, ids binary, cells binary"
LONG_MAX, LONG_MIN = 2**63 - 1, -(2**63)


def quantised(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row whether it takes part, its length, and floor(256 x) of the rows that do, flat.

    A null row, a null component and a component that is not finite leave the row out.
    """
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.where(column.is_null(), 0, column.value_lengths().fill_null(0).to_numpy(False))
    cells = column.flatten()
    values = cells.fill_null(np.nan).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    good = ~np.asarray(column.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    good[owner[~np.isfinite(values)]] = False
    with np.errstate(over="ignore"):
        return good, lengths, np.floor(values[good[owner]] * SCALE)


def _blocks(
    ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray, rows: int
) -> Iterator[tuple[int, str, bytes, bytes]]:
    """Packed blocks of vectors of one length, in id order within a block."""
    owner = np.repeat(np.arange(len(ids)), lengths)
    for dim in np.unique(lengths).tolist():
        chosen = np.flatnonzero(lengths == dim)
        cells = flat[lengths[owner] == dim].reshape(len(chosen), dim)
        order = np.argsort(ids[chosen], kind="stable")
        for at in range(0, len(order), rows):
            part = order[at : at + rows]
            block = cells[part]
            small = not block.size or np.abs(block).max() < 2**15
            kind = "<i2" if small else "<f8"
            yield dim, kind, ids[chosen][part].astype("<i8").tobytes(), block.astype(kind).tobytes()


def _record(rows: list[tuple], first: int) -> pa.RecordBatch:
    dims, kinds, ids, cells = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(first, first + len(rows)), pa.int64()),
            pa.array(dims, pa.int32()),
            pa.array(kinds, pa.string()),
            pa.array(ids, pa.binary()),
            pa.array(cells, pa.binary()),
        ],
        names=["block", "dim", "kind", "ids", "cells"],
    )


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` vectors (columns id, vector), each from one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                good, lengths, flat = quantised(part.column(1))
                ids = part.column(0).to_numpy(zero_copy_only=False)[good]
                yield _record(list(_blocks(ids, lengths[good], flat, rows)), 0)

    return vectors.mapInArrow(run, BLOCK)


def _matrix(kind: str, cells: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(cells, dtype=kind).reshape(n, dim)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows: in floats while every sum is exact."""
    peak = [float(np.abs(m.astype(np.float64)).max()) if m.size else 0.0 for m in (left, right)]
    bound = peak[0] * peak[1] * max(1, left.shape[1])
    if bound < 2**24:
        return (left.astype(np.float32) @ right.astype(np.float32).T).astype(np.float64)
    if bound < 2**53:
        return left.astype(np.float64) @ right.astype(np.float64).T
    exact = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (left, right)]
    return np.clip(exact[0] @ exact[1].T, LONG_MIN, LONG_MAX)


def tile_top(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score): the k best of a tile per query; ``ids`` are in order.

    Equal scores go to the smaller id; rows with the query's own id are left out.
    """
    step = max(1, SCORES // max(1, len(ids)))
    for at in range(0, len(query_ids), step):
        scores = products(queries[at : at + step], rows)
        for query, line in zip(query_ids[at : at + step].tolist(), scores, strict=True):
            low, high = np.searchsorted(ids, query, "left"), np.searchsorted(ids, query, "right")
            if high > low:
                line = np.delete(line, slice(low, high))
                others = np.delete(ids, slice(low, high))
            else:
                others = ids
            if len(line) > k:
                least = np.partition(line, len(line) - k)[len(line) - k]
                above = np.flatnonzero(line > least)
                equal = np.flatnonzero(line == least)[: k - len(above)]
                chosen = np.concatenate([above, equal])
            else:
                chosen = np.arange(len(line))
            for x in chosen.tolist():
                yield query, int(others[x]), int(line[x])


def _best(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products per query.

    Components become floor(256 x). Vectors that are null or hold a null or non-finite
    component, and rows without an id, take no part; vectors of different length are not
    compared. Repeated query rows count once, repeated candidate rows each. A query has fewer
    rows when fewer candidates exist, and none when there are none. Scores beyond a long are
    cut to its range.
    """
    columns = [F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")]
    asked = queries.where(F.col(key).isNotNull()).select(*columns).dropDuplicates()
    rows = candidates.where(F.col(key).isNotNull()).select(*columns)
    right = stash(packed(rows, CANDIDATE_ROWS), "candidates")
    right = right.withColumn("block", F.xxhash64("ids"))
    asked = stash(asked, "queries")
    number = -(-asked.count() // QUERY_ROWS) or 1

    def pack(group: pa.Table) -> pa.Table:
        good, lengths, flat = quantised(group.column("vector").combine_chunks())
        ids = group.column("id").to_numpy()[good]
        first = group.column("part")[0].as_py() << 32
        blocks = list(_blocks(ids, lengths[good], flat, QUERY_ROWS))
        return pa.Table.from_batches([_record(blocks, first)])

    spread = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(number)))
    left = stash(spread.groupBy("part").applyInArrow(pack, BLOCK), "query_blocks")

    # Names of the blocks only; the blocks themselves travel once per tile.
    tiles = left.select("dim", F.col("block").alias("q")).join(
        right.select("dim", F.col("block").alias("c")).distinct(), "dim"
    )
    tiles = stash(tiles.select("q", "c"), "tiles")
    cells = ["dim", "kind", "ids", "cells"]
    lefts = tiles.join(left.withColumnRenamed("block", "q"), "q").select("q", "c", *cells)
    rights = tiles.join(right.withColumnRenamed("block", "c"), "c").select(
        F.col("q").alias("q2"), F.col("c").alias("c2"), *cells
    )

    def multiply(names: tuple, one: pa.Table, many: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        sides = []
        for side in (one, many):
            sides.append([])
            for row in side.select(["dim", "kind", "ids", "cells"]).to_pylist():
                ids = np.frombuffer(row["ids"], dtype="<i8")
                sides[-1].append((ids, _matrix(row["kind"], row["cells"], row["dim"], len(ids))))
        for query_ids, matrix in sides[0]:
            for ids, block in sides[1]:
                found.extend(tile_top(query_ids, matrix, ids, block, k))
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        branch = [names[1].as_py()] * len(found)
        return pa.table(
            {
                "query_id": pa.array(columns[0], pa.int64()),
                "vec_id": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], pa.int64()),
                "branch": pa.array(branch, pa.int64()),
            }
        )

    lists = (
        lefts.groupBy("q", "c")
        .cogroup(rights.groupBy("q2", "c2"))
        .applyInArrow(multiply, "query_id long, vec_id long, score long, branch long")
    )
    branches = F.lit(max(1, right.count() // FAN_IN))
    lists = lists.withColumn("branch", F.pmod("branch", branches))
    near = _best(lists, ["query_id", "branch"], k).drop("rank")
    return _best(near, ["query_id"], k).select("query_id", "rank", "vec_id", "score")
