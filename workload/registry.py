"""Registration of queries with their SQL and the survey items they exercise."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None
    covers: str


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run.__name__, run, sql, covers)
        return run

    return register


# Schema of each file already seen, so that only the first query infers it.
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def with_ctes(ctes: dict[str, str], final: str) -> str:
    """``final`` preceded by the named subqueries it reaches, in their order."""
    needed: set[str] = set()
    pending = [final]
    while pending:
        text = pending.pop()
        for name in ctes.keys() - needed:
            if re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(ctes[name])
    chosen = [f"{name} AS ({body})" for name, body in ctes.items() if name in needed]
    return f"WITH {', '.join(chosen)} {final}" if chosen else final
