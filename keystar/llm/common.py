"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Records in one Arrow batch where rows are whole texts; bounds a Python worker's memory.
TEXT_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(column: pa.Array) -> list[str]:
    """A string column as Python strings, null as the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def encoded(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8, null as the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = TEXT_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Plain Python rows; longs stay exact beside nulls."""
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def join_sized(
    many: DataFrame, keyed: DataFrame, on: list[str], size: str, hot_keys: int = 1000
) -> DataFrame:
    """Inner join where ``keyed`` has one narrow row per key and says how often ``many`` has it.

    A key with more than one in ``hot_keys`` of the rows is hot; there are fewer than
    ``hot_keys`` of them whatever the input, so these rows are broadcast. No other key is large
    enough to hold up a shuffle. Both sides should be written tables: they are read twice.
    """
    share = (keyed.agg(F.sum(size)).first()[0] or 0) / hot_keys
    hot, cold = keyed.where(F.col(size) > share), keyed.where(F.col(size) <= share)
    rest = many.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return many.join(F.broadcast(hot), on).unionByName(rest.join(cold, on))


ARROW_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
}


def record(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows as a batch of a flat schema such as ``a long, b string``."""
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, ARROW_TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker.

    Batch functions travel by value, so their own module state would be new in every task;
    vocabulary look-ups are worth keeping from one task to the next. Callers bound its size.
    """
    module = sys.modules.setdefault("_keystar_worker", types.ModuleType("_keystar_worker"))
    return module.__dict__.setdefault(name, {})
