"""Grouped medians and deviations against the statistics module, with groups of every shape."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tq.functions import frames
from tq.operators import spread
from tq.operators.spread import Scratch, bounds, group_outliers, group_spread, outside_bounds


def expected(rows):
    groups = {}
    for *g, v in rows:
        if v is not None and math.isfinite(v):
            groups.setdefault(tuple(g), []).append(v)
    out = {}
    for g, values in groups.items():
        m = statistics.median(values)
        out[g] = (len(values), m, statistics.median([abs(v - m) for v in values]))
    return out


def check(spark, rows, **options):
    frame = spark.createDataFrame(rows, "a string, b int, v double").repartition(4)
    got = {(r.a, r.b): (r.n, r.median, r.mad) for r in group_spread(frame, ["a", "b"], "v", **options).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-300), g


def sample(seed=1):
    """A third of the rows in one group; groups of one row, of equal rows, of one repeated value among others, NULL groups,
    values of all sizes."""
    r = random.Random(seed)
    rows = [("hot", 1, r.gauss(0, 1) * 10 ** r.randint(-3, 6)) for _ in range(3000)]
    for i in range(300):
        rows += [(f"g{i % 40}", i % 7, r.choice([r.random(), float(r.randint(-3, 3)), 1e300 * r.random(), -5e-324])) for _ in range(r.randint(1, 30))]
    rows += [(None, None, float(r.randint(0, 9))) for _ in range(500)] + [(None, 1, 2.5), ("same", 1, 7.0), ("same", 1, 7.0), ("one", None, -0.0)]
    rows += [("odd", 2, x) for x in (None, math.nan, math.inf, -math.inf, 4.0)] + [("none", 3, None), ("nan", 3, math.nan)]
    r.shuffle(rows)
    return rows


def test_groups_of_every_shape(spark):
    check(spark, sample())


def test_large_states_are_joined_by_group_and_part(spark, monkeypatch):
    monkeypatch.setattr(frames, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(spread, "SALTS", 5)
    rows = [x for i, x in enumerate(sample(2)) if i % 3 == 0]
    check(spark, rows)


@pytest.mark.parametrize("small", [0, 3, 12])
@pytest.mark.parametrize("broadcast", [0, 2_000_000])
def test_small_and_large_groups_side_by_side(spark, monkeypatch, small, broadcast):
    monkeypatch.setattr(spread, "SMALL", small)
    monkeypatch.setattr(frames, "MAX_BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(spread, "SALTS", 5)
    tiny = [math.nextafter(1e15, math.inf) + 0.125 * i for i in range(40)]
    check(spark, [x for i, x in enumerate(sample(3)) if i % 4 == 0] + [("t", 0, v) for v in tiny])
    whole = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    assert [tuple(r) for r in group_spread(whole, [], "v").collect()] == [(10, 4.5, 2.5)]


def test_many_small_groups_need_no_copies_of_their_brackets(spark, monkeypatch):
    """Their number does not matter: no table of brackets is written or dealt ``SALTS`` times."""
    monkeypatch.setattr(frames, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(spread, "with_groups", None)
    check(spark, [(f"g{i % 500}", i % 3, float(i * i % 97)) for i in range(3000)])


def test_close_and_far_values(spark):
    """Neighbouring doubles, and a range that overflows: the buckets still part them."""
    tiny = [math.nextafter(1e15, math.inf) + 0.125 * i for i in range(40)]
    wide = [-0.8e308, 0.8e308, 0.0, 1.0, -1.0, 1e-300, 2.0]
    check(spark, [("t", 0, v) for v in tiny] + [("w", 0, v) for v in wide] + [("h", 0, 1.6e308 + i * 1e293) for i in range(31)])


def test_no_rows_no_group_column(spark):
    empty = spark.createDataFrame([], "a string, v double")
    assert group_spread(empty, ["a"], "v").collect() == []
    whole = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    assert [tuple(r) for r in group_spread(whole, [], "v").collect()] == [(10, 4.5, 2.5)]


def test_bounds_and_rows_outside(spark):
    rows = [("a", i, float(i % 10)) for i in range(100)] + [("a", 900, 40.0), ("a", 901, -40.0), ("a", 902, None), ("b", 1, 5000.0), (None, 2, 1.0), ("c", 3, math.nan)]
    frame = spark.createDataFrame(rows, "g string, id int, v double")
    assert sorted(r.id for r in group_outliers(frame, ["g"], "v", cutoff=4, least=20).collect()) == [900, 901]
    limits = bounds(group_spread(frame, ["g"], "v"), 4, 20)
    assert [r.g for r in limits.collect()] == ["a"]   # b, c and NULL are too small
    flagged = outside_bounds(frame, limits, ["g"], F.col("v"), "far")
    assert flagged.columns == ["g", "id", "v", "far"] and flagged.count() == len(rows)
    assert sorted(r.id for r in flagged.filter("far").collect()) == [900, 901]


def test_tables_go(spark, tmp_path):
    import glob
    import os

    scratch = Scratch(spark, "spread-test")
    out = group_spread(spark.createDataFrame([("a", 1.0), ("a", 3.0)], "g string, v double"), ["g"], "v", scratch)
    assert [tuple(r) for r in out.collect()] == [("a", 2, 2.0, 1.0)]
    assert len(scratch.paths) == 1   # only the result is left
    folder = scratch.paths[0].replace("file:", "")
    assert os.path.isdir(folder)
    scratch.release()
    assert not os.path.isdir(folder) and not glob.glob(folder + "*")
