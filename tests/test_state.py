"""Mergeable profile state: merged slices equal a whole run, drift distances against plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from tq.operators import state
from tq.operators.explore import missing_pairs
from tq.operators.profile import profile
from tq.operators.state import add_slice, bucket_state, distances, drift, merged_profile, number_bucket
from tq.plans import catalog


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "k string, v double, n int")


def test_merged_slices_equal_the_whole(spark, tmp_path):
    rows = [(None if i % 11 == 0 else ["", f"t{i % 57}", str(i)][i % 3], None if i % 5 == 0 else i * 0.5, i % 9) for i in range(600)]
    path = str(tmp_path / "state")
    for day, part in enumerate((rows[:50], rows[50:51], rows[51:])):
        add_slice(rows_of(spark, part), path, f"d{day}")
    add_slice(rows_of(spark, rows[50:51]), path, "d1")   # a retried day counts once
    add_slice(rows_of(spark, []), path, "empty")
    got = {r.column: r for r in merged_profile(spark, path, probs=(0.5, 0.9)).collect()}
    exact = {r.column: r for r in profile(rows_of(spark, rows), approx=False, exact_distinct=True).collect()}
    for c, want in exact.items():
        assert [got[c][x] for x in ("rows", "missing_count", "missing_pct", "numeric_min", "numeric_max")] == [
            want[x] for x in ("rows", "missing_count", "missing_pct", "numeric_min", "numeric_max")]
        assert abs(got[c].distinct_approx - want.distinct_exact) <= max(1, 3 * 0.01625 * want.distinct_exact)
    values = sorted(v for _, v, _ in rows if v is not None)
    for p, found in ((0.5, got["v"].q0_5), (0.9, got["v"].q0_9)):
        rank = sum(v <= found for v in values) / len(values)
        assert abs(rank - p) < 0.02
    only = {r.column: r.rows for r in merged_profile(spark, path, slices=["d0", "d1"]).collect()}
    assert only == {"k": 51, "v": 51, "n": 51}


def test_columns_without_numbers_and_empty_texts(spark, tmp_path):
    path = str(tmp_path / "state")
    add_slice(spark.createDataFrame([("",), ("a",), ("nan",), (None,)], "t string"), path, "x")
    row = merged_profile(spark, path).first()
    assert (row.rows, row.missing_count, row.numeric_min, row.q0_5, row.distinct_approx) == (4, 2, None, None, 3)


@pytest.mark.parametrize("v, bucket", [(0.0, 0), (1.0, 55), (9.99, 63), (10.0, 64), (-10.0, -64), (123.0, 73), (1e-9, 1), (5e300, 171), (0.02, 38)])
def test_number_bucket(spark, v, bucket):
    assert spark.range(1).select(number_bucket(F.lit(v)).alias("b")).first().b == bucket


def test_distances(spark):
    a = [("x", "number", 1, 50), ("x", "number", 5, 50), ("x", "missing", 0, 100), ("t", "text", 7, 10)]
    b = [("x", "number", 1, 10), ("x", "number", 9, 90), ("t", "text", 7, 5), ("t", "text", 8, 5)]
    schema = "column string, kind string, bucket int, n bigint"
    got = {r.column: r for r in distances(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}

    def psi(pairs):
        na, nb, k = sum(p for p, _ in pairs), sum(q for _, q in pairs), len(pairs)
        shares = [((p + 0.5) / (na + 0.5 * k), (q + 0.5) / (nb + 0.5 * k)) for p, q in pairs]
        return round(sum((p - q) * math.log(p / q) for p, q in shares), 6)

    x = got["x"]
    assert (x.rows_a, x.rows_b, x.missing_pct_a, x.missing_pct_b, x.ks) == (200, 100, 50.0, 0.0, 0.9)
    assert x.psi == pytest.approx(psi([(50, 10), (50, 0), (0, 90), (100, 0)]), abs=1e-6) and x.drifted
    assert got["t"].ks is None and got["t"].psi == pytest.approx(psi([(10, 5), (0, 5)]), abs=1e-6)


def test_drift_reads_the_state_alone(spark, tmp_path):
    path = str(tmp_path / "state")
    same = [(f"t{i % 5}", float(i % 20), 1) for i in range(200)]
    for name, rows in (("a", same), ("b1", same[:120]), ("b2", same[120:]), ("c", [("new", v + 500, 1) for _, v, _ in same])):
        add_slice(rows_of(spark, rows), path, name)
    assert not any(r.drifted for r in drift(spark, path, ["a"], ["b1", "b2"]).collect())
    found = {r.column: r for r in drift(spark, path, ["a"], ["c"]).collect()}
    assert found["v"].ks == 1.0 and found["v"].drifted and found["k"].drifted and not found["n"].drifted
    assert state.PSI_LIMIT < found["k"].psi


def test_missing_pairs(spark):
    names = [f"c{i}" for i in range(90)]
    rows = [[None if (i * j) % 7 == 0 else (" " if (i + j) % 11 == 0 else "x") for j in range(90)] for i in range(60)]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    gone = [[v is None or v == " " for v in r] for r in rows]
    got = {(r.a, r.b): tuple(r)[2:] for r in missing_pairs(frame).collect()}
    assert len(got) == 90 * 89 // 2
    for i in range(90):
        for j in range(i + 1, 90):
            both = sum(r[i] and r[j] for r in gone)
            a, b = sum(r[i] for r in gone) - both, sum(r[j] for r in gone) - both
            assert got[names[i], names[j]] == (both, a, b, 60 - both - a - b)
    assert [tuple(r)[2:] for r in missing_pairs(spark.createDataFrame([], "a string, b int")).collect()] == [(0, 0, 0, 0)]


def test_a_cell_is_judged_by_one_expression_whatever_the_number_of_columns(spark):
    def logs(columns):
        df = spark.createDataFrame([("1.5",) * columns, ("x",) * columns], ", ".join(f"c{i} string" for i in range(columns)))
        assert bucket_state(df).count() == 2 * columns
        return bucket_state(df)._jdf.queryExecution().optimizedPlan().toString().lower().count("log10")

    assert logs(1) == logs(6) > 0


def test_staged_rows_are_written_once(spark):
    df = spark.range(5).selectExpr("cast(id + 1 as string) as id", "if(id = 2, null, 'x') as t")
    staged = catalog._staged(spark, df)
    assert staged.columns == df.columns and sorted(staged.collect()) == sorted(df.collect())
    assert [f for f in staged.inputFiles() if "staged" in f]
