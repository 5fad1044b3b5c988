"""Profile, exact quantiles, exploration checks and the raw CSV round trip."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tq.config import LISTINGS
from tq.operators import explore as X
from tq.operators.normalize import normalize
from tq.operators.profile import duplicate_keys, duplicate_rows, empty_column_names, profile
from tq.operators.quantiles import exact_quantile_values
from tq.sources.files import read_raw_csv, write_raw_csv


def test_profile_semantics(spark):
    df = spark.createDataFrame(
        [("1", "$10.00", " b\nx "), ("2", "", "a"), (None, "5", "  "), ("x", "nan", None)],
        "id string, price string, t string")
    got = {r["column"]: r for r in profile(df, exact_distinct=True).collect()}
    assert got["id"]["missing_count"] == 1 and got["id"]["rows"] == 4
    assert got["price"]["missing_count"] == 1 and got["t"]["missing_count"] == 2
    assert got["t"]["missing_pct"] == 50.0
    assert (got["id"]["numeric_min"], got["id"]["numeric_max"]) == (1.0, 2.0)
    assert math.isnan(got["price"]["numeric_max"])          # text 'nan' parses to NaN, which sorts last
    assert got["price"]["numeric_min"] == 5.0               # currency text is not numeric here
    assert got["t"]["sample_value"] == "a"                   # smallest non-blank, trimmed
    assert got["id"]["distinct_exact"] == 3 and got["id"]["distinct_approx"] == 3


def test_profile_has_a_row_for_typed_and_nested_columns(spark):
    df = spark.createDataFrame([(1, [1.0], 2.5), (None, None, None)], "k bigint, v array<double>, x double")
    got = {r["column"]: r for r in profile(df).collect()}
    assert set(got) == {"k", "v", "x"}
    assert got["v"]["missing_count"] == 1 and got["v"]["numeric_max"] is None
    assert got["k"]["missing_count"] == 1 and got["x"]["numeric_max"] == 2.5 and got["k"]["sample_value"] is None


def test_duplicates_and_empty_columns(spark):
    df = spark.createDataFrame([("1", "a", None), ("1", "a", None), ("2", "b", " "), (None, "c", None),
                                (None, "d", None)], "id string, v string, e string")
    assert duplicate_rows(df).collect()[0][0] == 1
    assert duplicate_keys(df, "id").collect()[0][0] == 2      # NULL is one key value
    assert empty_column_names(normalize(df)) == ["e"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    values = [rnd.choice([rnd.gauss(0, 1e3), rnd.expovariate(1e-4), -rnd.random(), 0.0, 7.0]) for _ in range(3000)]
    values += [float("nan")] * 5 + [None] * 7
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    probs = [0.001, 0.01, 0.25, 0.5, 0.99, 0.999, 1.0]
    got = exact_quantile_values(df, "v", probs, buckets=16)
    data = sorted(v for v in values if v is not None and not math.isnan(v)) + [float("nan")] * 5
    n = len(data)
    for p in probs:
        want = data[max(1, math.ceil(p * n)) - 1]
        assert (math.isnan(got[p]) and math.isnan(want)) or got[p] == want, p


def test_exact_quantiles_on_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert exact_quantile_values(df, "v", [0.5]) == {0.5: None}


def test_format_check_examples_and_counts(spark):
    df = spark.createDataFrame([("$1,200.50",), ("12",), ("n/a",), ("n/a",), (" ",), (None,), ("€5",)], "price string")
    row = X.format_check(df, "price", r"^\$[0-9,]+(\.[0-9]+)?$", examples=2).collect()[0]
    assert row["bad_count"] == 4
    assert row["examples"] == "12 | n/a"


def test_top_values_put_nulls_last_and_break_ties_by_key(spark):
    df = spark.createDataFrame([("a", "5"), ("b", None), ("c", "9"), ("d", "9"), ("e", "1")], "id string, v string")
    got = [(r["id"], r["value"]) for r in X.top_values(df, F.col("v").try_cast("double"), "id", k=3).collect()]
    assert got == [("c", 9.0), ("d", 9.0), ("a", 5.0)]


def test_outside_box_needs_both_coordinates(spark):
    df = spark.createDataFrame([("40.0", "2.3"), ("48.8", None), ("48.8", "2.3")], "latitude string, longitude string")
    assert X.outside_box(df, LISTINGS.box).collect()[0][0] == 1


def test_raw_csv_round_trip_keeps_quotes_and_newlines(spark, tmp_path):
    df = spark.createDataFrame([("1", 'He said "ok"\nline two', " padded "), ("2", "", None)],
                               "id string, note string, other string")
    write_raw_csv(df, str(tmp_path / "csv"))
    back = {r["id"]: r for r in normalize(read_raw_csv(spark, str(tmp_path / "csv"))).collect()}
    assert back["1"]["note"] == 'He said "ok"\nline two'
    assert back["1"]["other"] == "padded"
    assert back["2"]["note"] is None and back["2"]["other"] is None


def test_explore_all_builds_every_check_present(spark):
    from tq.sources.tables import dirty

    checks = X.explore_all(dirty(spark, "/root/testdata/sf0.001"), LISTINGS)
    assert set(checks) == {"format_check", "non_positive", "quantiles", "top_values", "extremes", "score_ranges",
                           "date_order", "outside_box", "numeric_text_host_about"}
    assert checks["top_values"].count() == 5


def test_quantiles_with_infinite_and_undefined_values(spark):
    import math
    import random

    from tq.operators.quantiles import exact_quantile_values, exact_quantiles_of

    r = random.Random(9)
    inf, nan = math.inf, math.nan
    columns = [[1.0, 2.0, inf], [-inf, -inf, 3.0, nan], [inf], [nan], [None, None], [5e-324, 0.0, -0.0, 1.7e308, -1.7e308],
               [r.choice([inf, -inf, nan, r.gauss(0, 1e6), r.gauss(0, 1), 7.0]) for _ in range(500)], [2.0**53 + i for i in range(50)]]
    probs = [0.0, 0.01, 0.3, 0.5, 0.9, 0.999, 1.0]
    for values in columns:
        df = spark.createDataFrame([(v,) for v in values], "v double")
        ranked = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v if not math.isnan(v) else 0))
        got = exact_quantile_values(df, "v", probs, buckets=8, accuracy=50)
        for p in probs:
            want = ranked[max(1, math.ceil(p * len(ranked))) - 1] if ranked else None
            assert got[p] == want or (want is not None and math.isnan(want) and math.isnan(got[p])), (values[:5], p)
    two = spark.createDataFrame([(float(i), float(-i)) for i in range(101)], "a double, b double")
    assert exact_quantiles_of(two, {"a": [0.5], "b": [0.25, 1.0]}) == {"a": {0.5: 50.0}, "b": {0.25: -75.0, 1.0: 0.0}}


def test_profile_and_duplicates_cover_every_type(spark):
    from tq.operators.profile import duplicate_rows, profile, table_summary

    schema = "a array<int>, m map<string,array<map<int,int>>>, s struct<x:int,y:map<string,int>>, b binary, t string"
    row = ([1], {"k": [{1: 2, 3: 4}], "l": None}, (1, {"p": 1, "q": 2}), b"x", "t")
    turned = ([1], {"l": None, "k": [{3: 4, 1: 2}]}, (1, {"q": 2, "p": 1}), b"x", "t")   # the same maps in another order
    other = ([1], {"k": [{1: 2, 3: 5}], "l": None}, (1, {"p": 1, "q": 2}), b"x", "t")    # differs inside a map only
    df = spark.createDataFrame([row, turned, other, (None, None, None, None, " ")], schema)
    assert duplicate_rows(df).first()[0] == table_summary(df).first()["duplicate_rows"] == 1
    got = {r["column"]: r for r in profile(df, exact_distinct=True).collect()}
    assert [got[c]["missing_count"] for c in "amsbt"] == [1, 1, 1, 1, 1]
    assert [got[c]["distinct_exact"] for c in "amsbt"] == [1, 2, 1, 1, 2]
    assert all(got[c]["distinct_approx"] >= 1 for c in "amsbt")
