"""Vector columns (``array<float>``), computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine(left: Column, right: Column) -> Column:
    """NULL when either vector has no direction."""
    return F.try_divide(dot(left, right), norm(left) * norm(right))


def unit(vector: Column) -> Column:
    """The vector scaled to length 1, in double; NULL for a zero vector.

    The length is repeated beside the vector: inside the lambda it would be computed again
    for every element.
    """
    lengths = F.array_repeat(norm(vector), F.size(vector))
    scaled = F.zip_with(vector, lengths, lambda x, length: x.cast("double") / length)
    return F.when(has_direction(vector), scaled)


def has_direction(vector: Column) -> Column:
    return F.exists(vector, lambda x: x != 0)
