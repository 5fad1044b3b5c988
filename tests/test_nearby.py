"""Local outliers against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tq.operators import nearby
from tq.operators.nearby import isolated_places, local_outliers, neighbour_counts


def expected(rows, radius, least):
    """id -> neighbours of the isolated rows."""
    good = [(i, x, y) for i, x, y in rows if x is not None and y is not None and math.isfinite(x) and math.isfinite(y)]
    out = {}
    for i, x, y in good:
        n = sum((x - a) * (x - a) + (y - b) * (y - b) <= radius * radius for _, a, b in good) - 1
        if n < least:
            out[i] = n
    return out


def check(spark, rows, radius, least):
    frame = spark.createDataFrame(rows, "id int, x double, y double").repartition(4)
    got = {r.id: r.neighbours for r in local_outliers(frame, "x", "y", radius, least).collect()}
    assert got == expected(rows, radius, least)
    return got


@pytest.mark.parametrize("seed, radius, least", [(1, 0.5, 3), (2, 1.0, 5), (3, 0.25, 1), (4, 3.0, 20)])
def test_equals_all_pairs(spark, seed, radius, least):
    """Clusters, a hot place with a third of the rows, a grid whose distances are exactly the radius, strays."""
    r = random.Random(seed)
    points = [(r.gauss(0, 1), r.gauss(0, 1)) for _ in range(150)] + [(2.0, 2.0)] * 200
    points += [(10 + radius * (i % 6), radius * (i // 6)) for i in range(24)]
    points += [(r.uniform(-30, 30), r.uniform(-30, 30)) for _ in range(80)] + [(-20.0, -0.0), (-20.0, 0.0)]
    rows = [(i, *p) for i, p in enumerate(points)] + [(9001, None, 1.0), (9002, 1.0, None), (9003, math.nan, 1.0), (9004, math.inf, 0.0)]
    assert check(spark, rows, radius, least)


def test_edges(spark):
    assert check(spark, [(1, 0.0, 0.0)], 1.0, 1) == {1: 0}
    assert check(spark, [(1, 0.0, 0.0), (2, 0.0, 1.0)], 1.0, 1) == {}
    empty = spark.createDataFrame([], "id int, x double, y double")
    assert local_outliers(empty, "x", "y", 1.0, 2).collect() == []
    for radius, least in ((0.0, 1), (1.0, 0)):
        with pytest.raises(ValueError):
            isolated_places(empty, F.col("x"), F.col("y"), radius, least)


def test_crowded_cells_are_not_compared(spark):
    """4,000 places in one cell and three next to it: only the three are listed, and no more pairs than they need."""
    r = random.Random(5)
    rows = [(i, r.uniform(0, 0.3), r.uniform(0, 0.3)) for i in range(4000)] + [(9000 + i, 0.9 + i / 10, 0.2) for i in range(3)]
    frame = spark.createDataFrame(rows, "id int, x double, y double")
    counts = {r.x: r.neighbours for r in neighbour_counts(frame, F.col("x"), F.col("y"), 1.0, 10).collect()}
    assert sorted(counts) == [0.9, 1.0, 1.1]
    for i in range(3):
        x = 0.9 + i / 10
        assert counts[x] == sum((x - a) ** 2 + (0.2 - b) ** 2 <= 1 for _, a, b in rows) - 1
    assert nearby.SALTS > 1
