"""Numeric helpers for scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fraction(score: Column, scale: float = 1000.0, digits: int = 3) -> Column:
    """Integer score on a 0..scale range as a rounded fraction."""
    return F.round(score.cast("double") / scale, digits)


def as_percent(score: Column) -> Column:
    """Score clamped to [0, 1] as an integer percentage, halves rounded to even."""
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score.cast("double")))
    return F.bround(clamped * 100.0, 0).cast("int")


def phase_strength(phase: Column) -> Column:
    return F.least(F.lit(1.0), F.coalesce(phase.cast("double"), F.lit(0.0)) / 4.0)


def share_of_max(value: Column, largest: Column) -> Column:
    """Value relative to a group's largest, as a percentage; 0 when the largest is 0."""
    return F.when(largest != 0, value / largest * 100.0).otherwise(F.lit(0.0))
