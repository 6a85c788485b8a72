"""Grouped medians against sorting each group."""

from __future__ import annotations

import math
import random
from statistics import median

import pytest

from keystar.operators import median as M
from keystar.operators.median import grouped_median
from tests.conftest import rows


def plain(data):
    groups = {}
    for a, b, v in data:
        if v is not None:
            groups.setdefault((a, b), []).append(v)
    return sorted(((*k, median(sorted(vs)), len(vs)) for k, vs in groups.items()), key=repr)


@pytest.mark.parametrize(("most", "ranges"), [(100_000, 1024), (5, 4), (2, 2)])
def test_groups_of_any_shape(spark, monkeypatch, most, ranges):
    monkeypatch.setattr(M, "RANGES", ranges)
    rng = random.Random(most)
    data = [("hot", 1, rng.choice([rng.gauss(0, 1e3), rng.expovariate(1e-6), 7.0])) for _ in range(200)]
    data += [(f"g{rng.randrange(30)}", rng.choice([1, None]), round(rng.uniform(0, 14), 1)) for _ in range(150)]
    data += [
        (None, None, 1.0), (None, None, 2.0), ("none", 1, None), ("zero", 1, 0.0), ("zero", 1, -0.0),
        ("one", 2, -5.0), ("far", 2, -1.7e308), ("far", 2, 1.7e308), ("far", 2, 1e-320), ("far", 2, 3e-320),
        ("same", 2, 4.5), ("same", 2, 4.5), ("same", 2, 4.5),
    ]
    frame = spark.createDataFrame(data, "a string, b int, v double")
    got = rows(grouped_median(frame, ["a", "b"], "v", "m", most=most), "a", "b", "m", "n")
    assert got == plain(data)


def test_values_that_are_no_numbers(spark):
    data = [(1, v) for v in (1.0, 2.0, math.inf, math.inf, math.nan)] + [(2, -math.inf), (2, 3.0), (2, 4.0)]
    frame = spark.createDataFrame(data, "a int, v double")
    for most in (100, 2):
        assert rows(grouped_median(frame, ["a"], "v", "m", most=most)) == [(1, math.inf, 5), (2, 3.0, 3)]
    assert rows(grouped_median(frame.limit(0), ["a"], "v", "m")) == []


def test_no_task_counts_a_hot_group_by_itself(spark):
    """A third of the rows are one group with few values: tasks count them where they lie."""
    frame = spark.range(90_000, numPartitions=8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS g", "CAST(id % 7 AS DOUBLE) AS v"
    )
    found = grouped_median(frame, ["g"], "v", "m")
    assert found.where("g = 0").first()["m"] == 3.0
    assert found.count() == 60_001
