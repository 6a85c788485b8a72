"""Data-quality checks: each returns the violating rows, none means pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys seen more than once. A single key ignores NULL; a composite key counts it."""
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    counts = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where("row_count > 1")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key is absent in the parent."""
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return child.where(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("_parent"), "left_anti"
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with another value; NULL passes."""
    return df.where(~F.col(column).isin(*values))


def in_domain(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with another value or none at all."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(*values))


def in_range(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """Rows outside [low, high]; NULL passes."""
    return df.where((F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high)))


def no_self_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) == F.col(b))


def canonical_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs stored in the wrong order, then pairs stored twice; one count serves both."""
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("row_count"))
    reasons = F.array_compact(
        F.array(
            F.when(F.col(a) >= F.col(b), F.lit("order")),
            F.when(F.col("row_count") > 1, F.lit("repeat")),
        )
    )
    return counts.select(a, b, "row_count", F.explode(reasons).alias("violation"))


def length_matches(df: DataFrame, length: str, text: str) -> DataFrame:
    """Rows whose stored length is not positive or not the length of the text."""
    actual = F.length(text)
    return df.withColumn("actual_length", actual).where(
        (F.col(length) <= 0) | (F.col(length) != F.col("actual_length"))
    )


def volume_floor(df: DataFrame, minimum: int) -> DataFrame:
    """One row with the count when it is below the floor."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") < minimum)


def min_distinct(df: DataFrame, column: str, minimum: int) -> DataFrame:
    """One row when the column has fewer distinct values."""
    counted = df.agg(F.count_distinct(column).alias("distinct_count"))
    return counted.where(F.col("distinct_count") < minimum)


def domain_and_spread(
    df: DataFrame, key: str, column: str, values: Sequence[str], minimum: int
) -> DataFrame:
    """Rows outside the domain, plus one row when too few distinct values occur."""
    outside = in_domain(df, column, values).select(
        key, column, F.lit(f"unexpected_or_null_{column}").alias("violation")
    )
    key_type, column_type = df.schema[key].dataType, df.schema[column].dataType
    few = min_distinct(df, column, minimum).select(
        F.lit(None).cast(key_type).alias(key),
        F.lit(None).cast(column_type).alias(column),
        F.lit(f"fewer_than_{minimum}_distinct_{column}s").alias("violation"),
    )
    return outside.unionByName(few)


def composition_complete(
    composition: DataFrame, expected: DataFrame, key: str, letters: int, max_pct: float
) -> DataFrame:
    """Keys whose letter rows, counted letters or total share do not add up.

    ``expected`` has (key, standard_residues).
    """
    totals = composition.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("count").alias("total_counted"),
        F.sum("pct_of_sequence").alias("total_pct"),
    )
    wrong = (
        (F.col("n_rows") != letters)
        | (F.col("total_counted") != F.col("standard_residues"))
        | (F.col("total_pct") > max_pct)
    )
    return totals.join(expected, key).where(wrong)


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """Column names and types that differ from the declared schema (order and nulls aside)."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = sorted(found.keys() | wanted.keys())
    return [
        f"{n}: {found.get(n, 'absent')} instead of {wanted.get(n, 'nothing')}"
        for n in names
        if found.get(n) != wanted.get(n)
    ]


REAL_DATA = "real_data"


@dataclass(frozen=True)
class RowCheck:
    """A check on single rows of one relation: rows where ``condition`` holds are violations."""

    name: str
    relation: str
    condition: Callable[[], Column]
    tags: frozenset[str] = frozenset()

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return tables[self.relation].where(self.condition())


@dataclass(frozen=True)
class TableCheck:
    """A check that groups or joins: ``find`` returns the violating rows."""

    name: str
    find: Callable[[Mapping[str, DataFrame]], DataFrame]
    tags: frozenset[str] = frozenset()

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return self.find(tables)


@dataclass(frozen=True)
class UniqueCheck:
    """A key that no two rows may share; the violations are the keys that are."""

    name: str
    relation: str
    columns: tuple[str, ...]
    tags: frozenset[str] = frozenset()

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return unique(tables[self.relation], *self.columns)


@dataclass(frozen=True)
class ReferenceCheck:
    """A key that the parent has to have; the violations are the child rows without one."""

    name: str
    child: str
    column: str
    parent: str
    parent_column: str
    tags: frozenset[str] = frozenset()

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return relationships(
            tables[self.child], self.column, tables[self.parent], self.parent_column
        )


KeyCheck = UniqueCheck | ReferenceCheck
Check = RowCheck | TableCheck | KeyCheck


def select_checks(checks: Iterable[Check], exclude: Iterable[str] = ()) -> list[Check]:
    """Checks carrying none of the excluded tags."""
    banned = frozenset(exclude)
    return [check for check in checks if not check.tags & banned]


def summarize(checks: Iterable[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, violations) for all checks, as one job.

    Row checks of one relation share a single scan that reads only the columns they name; key
    checks of all relations share a single shuffle.
    """
    by_relation: dict[str, list[RowCheck]] = {}
    keyed: list[KeyCheck] = []
    results = []
    for check in checks:
        if isinstance(check, RowCheck):
            by_relation.setdefault(check.relation, []).append(check)
        elif isinstance(check, KeyCheck):
            keyed.append(check)
        else:
            counted = check.violations(tables).agg(F.count(F.lit(1)).alias("violations"))
            results.append(counted.select(F.lit(check.name).alias("check_name"), "violations"))
    for relation, group in by_relation.items():
        counts = tables[relation].agg(
            *(F.count_if(c.condition()).alias(f"c{i}") for i, c in enumerate(group))
        )
        pairs = F.array(
            *(
                F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("violations"))
                for i, c in enumerate(group)
            )
        )
        results.append(counts.select(F.inline(pairs)))
    if keyed:
        results.append(_key_violations(keyed, tables))
    return reduce(DataFrame.unionByName, results)


def _key_violations(checks: Sequence[KeyCheck], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, violations) of key checks: one scan per relation, one shuffle for all.

    Every row names, per check, its key and whether it holds it as a child or as a parent; they
    are counted per check and key before and after the shuffle, however many rows share a key.
    """
    asked: dict[str, list[tuple[int, tuple[str, ...], bool]]] = {}
    for i, check in enumerate(checks):
        if isinstance(check, UniqueCheck):
            asked.setdefault(check.relation, []).append((i, check.columns, False))
        else:
            asked.setdefault(check.child, []).append((i, (check.column,), False))
            asked.setdefault(check.parent, []).append((i, (check.parent_column,), True))

    def holder(i: int, columns: tuple[str, ...], parent: bool) -> Column:
        # Equal texts are equal keys; a single null key is no key, a composite one may have nulls.
        key = (
            F.col(columns[0]).cast("string")
            if len(columns) == 1
            else F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        )
        row = F.struct(F.lit(i).alias("check"), key.alias("key"), F.lit(parent).alias("parent"))
        return F.when(key.isNotNull(), row)

    held = [
        tables[relation].select(
            F.inline(F.filter(F.array(*(holder(*x) for x in wanted)), lambda r: r.isNotNull()))
        )
        for relation, wanted in asked.items()
    ]
    keys = reduce(DataFrame.unionByName, held).groupBy("check", "key").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.bool_or("parent").alias("known")
    )
    references = [i for i, check in enumerate(checks) if isinstance(check, ReferenceCheck)]
    lost = F.col("check").isin(references)
    violations = F.when(lost, F.when(F.col("known"), 0).otherwise(F.col("rows"))).otherwise(
        (F.col("rows") > 1).cast("long")
    )
    counted = keys.groupBy("check").agg(F.sum(violations).alias("violations"))
    # Checks whose relations have no keys at all passed too.
    names = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(c.name).alias("check_name")) for i, c in enumerate(checks)))
    all_names = tables[next(iter(asked))].sparkSession.range(1).select(F.inline(names))
    return all_names.join(counted, F.col("i") == F.col("check"), "left").select(
        "check_name", F.coalesce("violations", F.lit(0).cast("long")).alias("violations")
    )


def require(checks: Iterable[Check], tables: Mapping[str, DataFrame]) -> None:
    """Raise with the names of the checks that found violations, and how many."""
    found = summarize(checks, tables).where("violations > 0").orderBy("check_name").collect()
    if found:
        named = ", ".join(f"{r['check_name']} ({r['violations']})" for r in found)
        raise ValueError(f"checks violated: {named}")


def coverage(left: DataFrame, right: DataFrame, nulls: dict[str, Column]) -> DataFrame:
    """Row counts of two relations and, for the right one, how often each condition holds."""
    counts = right.agg(
        F.count(F.lit(1)).alias("right_rows"),
        *(F.count_if(condition).alias(name) for name, condition in nulls.items()),
    )
    total = left.agg(F.count(F.lit(1)).alias("left_rows"))
    return counts.withColumn("left_rows", total.scalar()).select("left_rows", *counts.columns)
