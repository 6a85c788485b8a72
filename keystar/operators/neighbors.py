"""Exact k nearest neighbours by cosine similarity.

Rows are dealt by a hash of their id into g bands, and the pairs of bands are the tasks: a row
travels to g of the g²/2 tasks, so what is shuffled grows with the rows times the root of the
tasks. Bands are as large as a task can hold, however small the strips that it multiplies. A
task multiplies its two bands block by block and keeps a running best k for every row of either,
so Spark never sees a row pair. Products are taken in single precision; those that could enter a
list, by the bound on their rounding, are taken again in double precision, which alone decides.
The work is that of all products, halved by their symmetry: the price of an exact answer on data
without structure.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystar import constants as K
from keystar.functions.vectors import has_direction
from keystar.operators.ranking import top_n
from keystar.session import stash

# Bytes of one band; a task holds two, in double precision.
STRIP_BYTES = 64 << 20
# Rows of one side of a matrix product inside a task.
BLOCK_ROWS = 1024
# Similarities are ranked as integers of this scale: 6 decimals, what float32 can hold.
SCALE = 1_000_000
# Tasks at most that get a partition each.
MOST_PARTITIONS = 10_000
# A block of which more than this share is to be taken again is taken again as a whole.
DENSE = 1 / 32
# An entry of a list is what its score lacks above these bits, its column within them.
COLUMN_BITS = 39
NOTHING = np.iinfo(np.int64).max


def cosine_topk(
    df: DataFrame,
    id: str,
    vector: str,
    k: int = K.NEIGHBOR_K,
    strip_rows: int | None = None,
) -> DataFrame:
    """(id, neighbor, similarity, rank 1..k), best first, ties by neighbour id.

    A row is not its own neighbour; rows without a direction (NULL, zero or not finite) neither
    have nor are neighbours. Similarity is rounded to 6 decimals. ``strip_rows`` sets the rows
    of a strip; strips that fit ``STRIP_BYTES`` together are one band, so that a row is not
    copied for every strip, and whole strips are multiplied at a time.
    """
    rows = df.select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(np.inf)))
    rows = rows.where(F.coalesce(finite & has_direction(F.col("vector")), F.lit(False)))
    # Counting and dealing read the vectors, so they are written once.
    rows = stash(rows, "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    n, dim = size["n"], size["dim"] or 1
    bands = min(_strips(rows, n, dim, strip_rows), _strips(rows, n, dim, None))
    best = _compare(_dealt(rows, bands), bands, k, rows.schema["id"].dataType, strip_rows)
    found = top_n(best, "id", k, F.desc("similarity"), F.asc("neighbor"))
    return found.withColumnRenamed("id", id)


def _strips(rows: DataFrame, n: int, dim: int, strip_rows: int | None) -> int:
    """Enough strips for their size, and for every core to have a pair of them."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    fitting = math.ceil(n / (strip_rows or max(1, STRIP_BYTES // (8 * dim))))
    return max(1, fitting, math.ceil(math.sqrt(2 * cores)))


def _dealt(rows: DataFrame, strips: int) -> DataFrame:
    """Every row once for each pair (a, b) of strips, a <= b, that its own strip is in."""
    own = F.pmod(F.xxhash64("id"), F.lit(strips)).cast("int")
    dealt = rows.select("id", "vector", own.alias("own")).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("other")
    )
    return dealt.select(
        F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        "own", "id", "vector",
    )


def apart(df: DataFrame, number: str, count: int) -> DataFrame:
    """The rows of each number below ``count`` in a partition of their own.

    Grouping by a hash would put several of a few large tasks into one partition and leave others
    empty; it is left to deal out more tasks than ``MOST_PARTITIONS``.
    """
    return df.repartitionById(max(1, count), number) if count <= MOST_PARTITIONS else df


def _compare(
    dealt: DataFrame, bands: int, k: int, id_type: T.DataType, strip_rows: int | None = None
) -> DataFrame:
    """Best k of each row within each of its pairs, as (id, neighbor, similarity)."""
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("neighbor", id_type),
            T.StructField("similarity", T.DoubleType()),
        ]
    )

    def compare(names: tuple, group: pa.Table) -> pa.Table:
        a, b = group.column("a")[0].as_py(), group.column("b")[0].as_py()
        group = group.sort_by("id")
        band = group.column("own").to_numpy()
        units = units_of(group.column("vector").combine_chunks())
        ids = group.column("id")
        left, right = np.flatnonzero(band == a), np.flatnonzero(band == b)
        if a == b:
            sides = [(left, left, *strip_topk(units, units, k, True, strip_rows))]
        else:
            one, two = pair_topk(units[left], units[right], k, strip_rows)
            sides = [(left, right, *one), (right, left, *two)]
        own = np.concatenate([mine[row] for mine, _, row, _, _ in sides])
        near = np.concatenate([others[at] for _, others, _, at, _ in sides])
        scores = np.concatenate([score for *_, score in sides])
        return pa.table(
            [ids.take(pa.array(own)), ids.take(pa.array(near)), pa.array(scores / SCALE)],
            names=["id", "neighbor", "similarity"],
        )

    # The pairs of a band with itself have half the work and come last, where they fill gaps.
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    mixed = bands * (bands - 1) // 2
    pair = F.when(a < b, (a * (2 * bands - a - 1) / 2).cast("long") + b - a - 1).otherwise(a + mixed)
    placed = apart(dealt.withColumn("pair", pair.cast("int")), "pair", mixed + bands)
    return placed.groupBy("pair").applyInArrow(compare, schema)


def units_of(column: pa.Array) -> np.ndarray:
    """Rows of length 1 in double precision; ``column`` has finite rows of one width with a direction."""
    if not len(column):
        return np.zeros((0, 0))
    matrix = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    matrix = matrix.astype(np.float64)
    return matrix / np.linalg.norm(matrix, axis=1)[:, None]


class Best:
    """The best k columns of each row so far, equal scores to the smaller column.

    ``ordered`` says that the columns come in increasing order: equal scores of later ones lose.
    An entry is one number, so that the smallest is the best: what the score lacks, then the column.
    """

    def __init__(self, rows: int, k: int, ordered: bool = True) -> None:
        self.k, self.ordered = k, ordered
        self.floor = np.full(rows, -4.0 * SCALE)
        self.entries = np.full((rows, k), NOTHING)
        # Found but not yet merged; until then the floor may be lower than it could be.
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting, self.most = 0, max(4 * BLOCK_ROWS, rows // 4)

    def take(
        self, near: np.ndarray, mine: np.ndarray, others: np.ndarray, rows: np.ndarray, columns: np.ndarray
    ) -> None:
        """A block: ``near`` has the products of ``mine[rows]`` with ``others[columns]``.

        They are in single precision; below -4 stands what is no pair.
        """
        floor = self.floor[rows]
        # Two roundings of the factors, one per sum, one of this bound; lengths are 1.
        slack = (mine.shape[1] + 8) * 2.0**-24
        least = (floor + (0.5 if self.ordered else -0.5)) / SCALE - slack
        if self.ordered:
            least[floor >= SCALE] = np.inf
        mask = near >= least.astype(np.float32)[:, None]
        count = np.count_nonzero(mask)
        if not count:
            return
        if count > DENSE * mask.size:
            hit = np.flatnonzero(mask.any(axis=1))
            row, at, score = self._dense(near[hit], mine[rows[hit]], others[columns], floor[hit])
            row, at = rows[hit[row]], columns[at]
        else:
            found = _few(mask.ravel(order="K"))
            if mask.flags.c_contiguous:
                row, at = np.divmod(found, near.shape[1])
            else:
                at, row = np.divmod(found, near.shape[0])
            row, at = rows[row], columns[at]
            score = np.rint(np.einsum("ij,ij->i", mine[row], others[at]) * SCALE)
        entry = (SCALE - score).astype(np.int64) << COLUMN_BITS | at
        wins = entry < self.entries[row, -1]
        self.found.append((row[wins], entry[wins]))
        self.waiting += np.count_nonzero(wins)
        if self.waiting > self.most:
            self._merge()

    def _dense(
        self, near: np.ndarray, mine: np.ndarray, others: np.ndarray, floor: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scores = _block(mine, others)
        scores[near < -4] = -5.0 * SCALE
        mask = scores >= floor[:, None]
        if scores.shape[1] > self.k:
            # A row cannot keep more than its k best of this block and what equals them.
            place = scores.shape[1] - self.k
            mask &= scores >= np.partition(scores, place, axis=1)[:, place][:, None]
        row, at = np.nonzero(mask)
        return row, at, scores[row, at]

    def _merge(self) -> None:
        row, entry = (np.concatenate(x) for x in zip(*self.found, strict=True))
        self.found, self.waiting = [], 0
        order = np.argsort(row, kind="stable")
        row, entry = row[order], entry[order]
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])[: len(row)])
        counts = np.diff(np.append(starts, len(row)))
        # Those of a row side by side, so many at a time.
        for done in range(0, counts.max(initial=0), 2 * self.k):
            more = np.flatnonzero(counts > done)
            slots = np.arange(min(2 * self.k, counts.max() - done))
            there = done + slots < counts[more][:, None]
            place = np.minimum(starts[more][:, None] + done + slots, len(entry) - 1)
            mine = row[starts[more]]
            both = np.concatenate([self.entries[mine], np.where(there, entry[place], NOTHING)], axis=1)
            both.sort(axis=1)
            self.entries[mine] = both[:, : self.k]
            self.floor[mine] = np.maximum(SCALE - (both[:, self.k - 1] >> COLUMN_BITS), -4.0 * SCALE)

    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.found:
            self._merge()
        row, rank = np.nonzero(self.entries < NOTHING)
        entry = self.entries[row, rank]
        return row, entry & ((1 << COLUMN_BITS) - 1), (SCALE - (entry >> COLUMN_BITS)).astype(np.float64)


def _few(flat: np.ndarray) -> np.ndarray:
    """Where a mask is set, eight cells at a time: of most blocks very little is."""
    if flat.size % 8:
        return np.flatnonzero(flat)
    eights = np.flatnonzero(flat.view(np.uint64))
    eight, cell = np.nonzero(flat.reshape(-1, 8)[eights])
    return eights[eight] * 8 + cell


def _block(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    scores = left @ right.T
    scores *= SCALE
    return np.rint(scores, out=scores)


def _products(
    left: np.ndarray, right: np.ndarray, step: int | None, same: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, their products in single precision) block by block, columns in order.

    A block has as many rows as make whole strips of ``step`` rows, and as many columns as keep
    its size. If the sides are the same, columns begin with the rows.
    """
    step = min(step or BLOCK_ROWS, BLOCK_ROWS)
    step *= BLOCK_ROWS // step
    width = BLOCK_ROWS * BLOCK_ROWS // step
    for i in range(0, len(left), step):
        rows = np.arange(i, min(i + step, len(left)))
        one = left[i : i + step].astype(np.float32)
        for j in range(i if same else 0, len(right), width):
            columns = np.arange(j, min(j + width, len(right)))
            yield rows, columns, one @ right[j : j + width].astype(np.float32).T


def strip_topk(
    left: np.ndarray, right: np.ndarray, k: int, same: bool = False, step: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the best k columns per row; not itself if the sides are the same."""
    best = Best(len(left), k)
    for rows, columns, near in _products(left, right, step, same):
        if same and rows[0] == columns[0]:
            np.fill_diagonal(near, -5)
        best.take(near, left, right, rows, columns)
        if same:
            # The other half of the products; the rows' own square was both.
            square = len(rows) if rows[0] == columns[0] else 0
            if square < len(columns):
                best.take(near[:, square:].T, left, left, columns[square:], rows)
    return best.lists()


def pair_topk(
    left: np.ndarray, right: np.ndarray, k: int, step: int | None = None
) -> tuple[tuple, tuple]:
    """The lists of both sides from one product of each pair of blocks."""
    one, two = Best(len(left), k), Best(len(right), k)
    for rows, columns, near in _products(left, right, step):
        one.take(near, left, right, rows, columns)
        two.take(near.T, right, left, columns, rows)
    return one.lists(), two.lists()
