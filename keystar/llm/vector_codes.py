"""Product-quantiser codes of integer vectors, with norm-of-sum bounds before exact rescans.

Every vector is cut into parts; each part position has a codebook that a few rounds of exact
integer k-means improve. The history of the codebooks is kept. A vector part keeps one lower
bound per group of entries, the distance measured when the group was last scanned, and the round
of that scan. In a later round the bound is lowered by the net way its entries have moved since,
the norm of the summed moves, which is never longer than the summed norms; groups that still
cannot hold the nearest entry are not scanned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystar.session import remove, scratch_path

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Entries that share a bound.
GROUP = 32
#: Bounds are stored as whole numbers; a larger distance is bounded by this one.
HIGHEST = 65535
#: Relative room for rounding in square roots.
ROOM = 1e-12
LONGEST = (1 << 63) - 1

#: A codebook of every part position: (parts, entries, width).
Codebooks = np.ndarray


def integers(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, v) of usable vectors, floored and padded with zeros to one length."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.transform(F.col(vector), lambda x: x.cast("double")).alias("x"),
    ).where(F.col("x").isNotNull() & F.forall("x", finite))
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    cells = F.transform("x", lambda x: F.floor(SCALE * x).cast("long"))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
    return rows.select("vec_id", "label", F.concat(cells, zeros).alias("v"))


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries: floats where those are exact, else integers."""
    largest = max(_largest(x), _largest(entries))
    if 4 * x.shape[1] * largest * largest < 1 << 53:
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)
    wide = entries.astype(object)
    found = np.empty((len(x), len(entries)), dtype=object)
    for i, row in enumerate(x.astype(object)):
        found[i] = ((wide - row) ** 2).sum(1) if x.shape[1] else 0
    return found


def _to_own(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to its own entry."""
    largest = max(_largest(x), _largest(entries))
    exact = np.float64 if 4 * x.shape[1] * largest * largest < 1 << 53 else object
    if not x.shape[1]:
        return np.zeros(len(x))
    return ((x.astype(exact) - entries.astype(exact)) ** 2).sum(1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def moved(history: list[np.ndarray]) -> np.ndarray:
    """(groups, rounds): the farthest net way of a group's entries from each round to the last."""
    last = history[-1].astype(np.float64)
    ways = np.array([np.sqrt(((last - old.astype(np.float64)) ** 2).sum(1)) for old in history])
    starts = np.arange(0, len(last), GROUP)
    return np.maximum.reduceat(ways, starts, axis=1).T * (1 + ROOM)


def assign(
    x: np.ndarray,
    code: np.ndarray,
    bound: np.ndarray,
    stamp: np.ndarray,
    history: list[np.ndarray],
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entry of every row of one part, ties to the lower index.

    ``bound`` (rows, groups) is a floor of the distance to every entry of a group but the row's
    own, in the codebook of round ``stamp``. Returns code, squared distance, bound and stamp
    for the last codebook of the history, and the number of row and group pairs scanned.
    """
    now = len(history) - 1
    entries = history[now]
    rows = np.arange(len(x))
    own = _to_own(x, entries[code])
    low = bound - moved(history)[np.arange(bound.shape[1]), stamp]
    scan = low <= _roots(own)[:, None] * (1 + ROOM)
    best, pick = own.copy(), code.copy()
    nearest = np.full(bound.shape, np.inf)
    second = np.full(bound.shape, np.inf)
    for g in range(bound.shape[1]):
        asked = rows[scan[:, g]]
        if not len(asked):
            continue
        first = g * GROUP
        found = distances(x[asked], entries[first : first + GROUP])
        here = (code[asked] >= first) & (code[asked] < first + GROUP)
        found[here, code[asked][here] - first] = np.inf
        at = found.argmin(1)
        line = np.arange(len(asked))
        least = found[line, at]
        found[line, at] = np.inf
        nearest[asked, g], second[asked, g] = _roots(least), _roots(found.min(1))
        entry = first + at
        closer = (least < best[asked]) | ((least == best[asked]) & (entry < pick[asked]))
        best[asked[closer]], pick[asked[closer]] = least[closer], entry[closer]

    changed = rows[pick != code]
    # The new entry leaves its group's bound, the old one enters its own group's.
    found_bound = np.where(scan, nearest, low)
    found_bound[changed, pick[changed] // GROUP] = second[changed, pick[changed] // GROUP]
    left = code[changed] // GROUP
    found_bound[changed, left] = np.minimum(found_bound[changed, left], _roots(own[changed]))
    renewed = scan.copy()
    renewed[changed, left] = True
    floors = np.floor(np.clip(found_bound * (1 - ROOM), 0, HIGHEST)).astype(np.uint16)
    return (
        pick,
        best,
        np.where(renewed, floors, bound),
        np.where(renewed, now, stamp).astype(np.uint8),
        int(scan.sum()),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists of longs."""
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(n, -1) if len(values) else np.zeros((n, 0), dtype=np.int64)


def _part(x: np.ndarray, part: int) -> np.ndarray:
    width = x.shape[1] // PARTS
    return x[:, part * width : (part + 1) * width]


STATE = "state binary, error long"


def assigned(rows: DataFrame, history: list[Codebooks]) -> DataFrame:
    """The rows (vec_id, label, v, state) with the state of the history's last codebooks.

    A state holds the codes, bounds and stamps of all parts in this order; null before the first
    assignment. ``error`` is the squared distance to the entries, summed over the parts.
    """
    groups = -(-history[0].shape[1] // GROUP)
    sizes = [PARTS, PARTS * groups * 2, PARTS * groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = _matrix(batch.column(2))
            blank = bytes(sum(sizes))
            states = b"".join(s or blank for s in batch.column(3).to_pylist())
            raw = np.frombuffer(states, dtype=np.uint8).reshape(n, sum(sizes))
            codes, bounds, stamps = np.split(raw, np.cumsum(sizes)[:-1], axis=1)
            bounds = bounds.copy().view("<u2").reshape(n, PARTS, groups)
            stamps = stamps.reshape(n, PARTS, groups)
            errors = np.zeros(n, dtype=object)
            found = []
            for p in range(PARTS):
                code, error, bound, stamp, _ = assign(
                    _part(x, p),
                    codes[:, p].astype(np.int64),
                    bounds[:, p],
                    stamps[:, p],
                    [books[p] for books in history],
                )
                errors += np.array([int(e) for e in error], dtype=object)
                found.append((code.astype(np.uint8)[:, None], bound.astype("<u2"), stamp))
            new = np.concatenate(
                [np.ascontiguousarray(f[i]).view(np.uint8) for i in range(3) for f in found], axis=1
            )
            states = pa.array([row.tobytes() for row in new], pa.binary())
            total = pa.array([min(int(e), LONGEST) for e in errors], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], states, total], names=["vec_id", "label", "v", "state", "error"]
            )

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v", "state").mapInArrow(
        run, f"vec_id long, label {label}, v array<long>, {STATE}"
    )


def sums(rows: DataFrame, entries: int) -> DataFrame:
    """(part, entry, position, n, total) over the rows' own entries; combined in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((PARTS, entries), dtype=np.int64)
        totals = None
        for batch in batches:
            x = _matrix(batch.column(0))
            if _largest(x) >= 1 << 40:
                x = x.astype(object)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8)
            codes = codes.reshape(len(x), -1)[:, :PARTS]
            if totals is None:
                totals = np.zeros((PARTS, entries, x.shape[1] // PARTS), dtype=object)
            for p in range(PARTS if len(x) else 0):
                order = np.argsort(codes[:, p], kind="stable")
                names, starts = np.unique(codes[order, p], return_index=True)
                counts[p, names] += np.diff(np.append(starts, len(x)))
                if x.shape[1]:
                    totals[p, names] += np.add.reduceat(_part(x, p)[order], starts, axis=0)
        if totals is None:
            return
        p, j = np.nonzero(counts)
        width = totals.shape[2]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(p, width), pa.int32()),
                pa.array(np.repeat(j, width), pa.int32()),
                pa.array(np.tile(np.arange(width), len(p)), pa.int32()),
                pa.array(np.repeat(counts[p, j], width), pa.int64()),
                pa.array([int(t) for t in totals[p, j].ravel()], pa.decimal128(38, 0)),
            ],
            names=["part", "entry", "position", "n", "total"],
        )

    partial = rows.select("v", "state").mapInArrow(
        run, "part int, entry int, position int, n long, total decimal(38,0)"
    )
    return partial.groupBy("part", "entry", "position").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every used entry moves to the floored mean of its parts; its size is that of the codebooks."""
    new = books.copy()
    for row in sums(rows, books.shape[1]).collect():
        new[row.part, row.entry, row.position] = int(row.total) // row.n
    return new


def first_codebooks(rows: DataFrame) -> Codebooks:
    """The parts of the rows with the smallest ids; rows without an id come last."""
    order = F.col("vec_id").asc_nulls_last()
    chosen = rows.select("vec_id", "v").orderBy(order, "v").limit(ENTRIES).collect()
    if not chosen:
        return np.zeros((PARTS, 0, 0), dtype=np.int64)
    x = np.array([r.v for r in chosen], dtype=np.int64)
    return np.stack([_part(x, p) for p in range(PARTS)])


def codebooks_text(books: Codebooks) -> str:
    return ",".join(str(int(x)) for x in books.ravel())


def vector_codes(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per usable vector.

    Vectors that are null or hold a null or non-finite component are left out. Shorter vectors
    count as continued with zeros, up to the longest length and to a multiple of the parts;
    components beyond the range of a long are taken as its ends, sums beyond it as its
    largest. Fewer vectors than entries make smaller codebooks. Repeated ids are separate rows;
    rows without an id take part and come last in the order of ids. Rows without a label share
    one ``label_error``. An empty table gives no rows. Other columns are not read.

    Codebooks and their history are all that is sent to tasks: (rounds + 1) x 256 entries,
    whatever the number of vectors. Each round writes vectors and states anew to the shared
    folder and then removes the round before it.
    """
    spark = vectors.sparkSession

    def written(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        return spark.read.parquet(path), path

    blank = F.lit(None).cast("binary").alias("state")
    rows, path = written(integers(vectors, key, vector, label).select("*", blank), "integers")
    history = [first_codebooks(rows)]
    if not history[0].shape[1]:
        return rows.select(
            "vec_id",
            F.lit("").alias("code"),
            F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("label_error"),
            F.lit("").alias("codebooks_sha256"),
        )
    for round_ in range(ROUNDS + 1):
        before = path
        rows, path = written(assigned(rows, history), "codes")
        remove(spark, before)
        if round_ < ROUNDS:
            history.append(improved(rows, history[-1]))

    digest = hashlib.sha256(codebooks_text(history[-1]).encode()).hexdigest()
    wide = F.sum(F.col("error").cast("decimal(38,0)"))
    of_label, path = written(
        rows.groupBy("label").agg(F.least(wide, F.lit(LONGEST)).cast("long").alias("label_error")),
        "labels",
    )
    return rows.join(of_label, rows.label.eqNullSafe(of_label.label)).select(
        "vec_id",
        F.lower(F.hex(F.substring("state", 1, PARTS))).alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
