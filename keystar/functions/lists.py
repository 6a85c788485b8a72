"""Array columns: safe first elements, filters and delimited text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_element(values: Column) -> Column:
    """First element, NULL when the list is empty or missing."""
    return F.get(values, F.lit(0))


def first_where(values: Column, keep: Callable[[Column], Column]) -> Column:
    return first_element(F.filter(values, keep))


def or_empty(values: Column, element: str = "string") -> Column:
    return F.coalesce(values, F.array().cast(f"array<{element}>"))


def has_text(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def distinct_texts(values: Column) -> Column:
    """Non-empty values, first occurrence kept, input order kept; missing list -> empty."""
    return F.array_distinct(F.filter(or_empty(values), has_text))


# White space at either end of a text, beyond ASCII too.
_EDGES = r"^[\s\x0B\x1C-\x1F\x85\p{Z}]+|[\s\x0B\x1C-\x1F\x85\p{Z}]+$"


def split_labels(value: Column, sep: str = ",") -> Column:
    """Comma-separated labels as a list without outer white space or blanks; no text -> empty."""
    parts = F.transform(F.split(value, sep), lambda part: F.regexp_replace(part, _EDGES, ""))
    return F.filter(or_empty(parts), lambda token: token != "")


def keep_scored(items: Column, field: str, minimum: float | Column) -> Column:
    """Entries of a struct list whose score field reaches the minimum."""
    floor = minimum if isinstance(minimum, Column) else F.lit(minimum)
    return F.filter(items, lambda item: item[field] >= floor)


def sort_by_score(items: Column, field: str, key: str) -> Column:
    """Struct list ordered by score, highest first (a missing score counts as 0), then by key."""

    def order(left: Column, right: Column) -> Column:
        a, b = F.coalesce(left[field], F.lit(0)), F.coalesce(right[field], F.lit(0))
        return (
            F.when(a > b, -1)
            .when(a < b, 1)
            .when(left[key] < right[key], -1)
            .when(left[key] > right[key], 1)
            .otherwise(0)
        )

    return F.array_sort(items, order)
