"""Targeted exploration of suspected defects on the raw text table.

Every count of a check is a ``count_if`` inside one aggregate (one scan), not
one job per predicate.  Top-k lists use ``orderBy(..).limit(k)`` (planned as
``TakeOrderedAndProject``: each task keeps its k best rows) or a per-group
``row_number() <= k`` (planned with ``WindowGroupLimit``, which trims every
task to k rows per group before the shuffle).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tq.functions.columns import col, count_if, is_blank, parse_currency, safe_cast
from tq.session import materialize
from tq.operators.quantiles import approx_quantiles, exact_quantiles, exact_quantiles_of

# fixed values: how a price is written, and the probabilities its distribution is read at
PRICE_FORMAT = r"^\$[0-9,]+(\.[0-9]+)?$"
PRICE_PROBS = (0.01, 0.5, 0.99, 0.999)
# end of fixed values


def _num(name: str) -> Column:
    return safe_cast(name, "double")


def format_check(df: DataFrame, column: str, pattern: str, examples: int = 5) -> DataFrame:
    """One row: ``column, bad_count, examples`` — non-blank values not matching ``pattern``.

    ``examples`` = the smallest distinct offending values joined by `` | ``.
    """
    bad = df.filter(~is_blank(column) & ~col(column).rlike(pattern)).select(col(column).alias("v"))
    counted = bad.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(None).cast("string").alias("v"))
    shown = bad.distinct().orderBy("v").limit(examples).select(F.lit(0).cast("bigint").alias("n"), "v")
    return counted.unionByName(shown).agg(
        F.lit(column).alias("column"),
        F.sum("n").cast("bigint").alias("bad_count"),
        F.array_join(F.array_sort(F.collect_list("v")), " | ").alias("examples"),
    )


def non_positive(df: DataFrame, column: str, currency: bool = True) -> DataFrame:
    v = parse_currency(column) if currency else _num(column)
    return df.agg(count_if(v <= 0).alias("non_positive"))


def top_values(df: DataFrame, value: Column, key: str, k: int = 5, name: str = "value") -> DataFrame:
    """The ``k`` largest values with their key; NULL values last, ties by key."""
    return (df.select(col(key).alias(key), value.alias(name))
            .orderBy(F.col(name).desc_nulls_last(), F.col(key).asc_nulls_first()).limit(k))


def cross_missing(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows where exactly one of two related columns is blank, in both directions."""
    return df.agg(count_if(is_blank(a) & ~is_blank(b)).alias(f"{a}_missing_{b}_present"),
                  count_if(~is_blank(a) & is_blank(b)).alias(f"{a}_present_{b}_missing"))


def missing_pairs(df: DataFrame, columns=None) -> DataFrame:
    """``(a, b, both_missing, only_a_missing, only_b_missing, none_missing)`` of every pair of columns, in schema order.

    One scan: rows are grouped by a mask of their missing columns (combined map-side), the pairs are
    counted from the distinct masks, of which real tables have few.
    """
    names = list(columns or df.columns)
    mask = F.concat(*[F.when(_is_missing(df, c), F.lit("1")).otherwise(F.lit("0")) for c in names], F.lit(""))
    masks = df.select(mask.alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
    # the distinct masks are written once: the plan behind them need not be optimised again with the pairs
    masks = materialize(masks)
    places = F.sequence(F.lit(0), F.lit(max(0, len(names) - 1)))
    missing = F.filter(places, lambda i: F.col("mask").substr(i + 1, F.lit(1)) == "1")
    # -1 stands for the table itself, so the counts of single columns and of all rows come from the same rows
    listed = masks.select("n", F.concat(F.array(F.lit(-1)), missing).alias("at"))
    pairs = listed.select("n", "at", F.explode("at").alias("i")).select("n", "i", F.explode("at").alias("j")).filter("i < j or i = -1")
    # one row per pair of columns at most, whatever the table
    found = {(r["i"], r["j"]): r["n"] for r in pairs.groupBy("i", "j").agg(F.sum("n").alias("n")).collect()}
    rows, of = found.get((-1, -1), 0), [found.get((-1, i), 0) for i in range(len(names))]
    out = []
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            both = found.get((i, j), 0)
            out.append((a, names[j], both, of[i] - both, of[j] - both, rows - of[i] - of[j] + both))
    return df.sparkSession.createDataFrame(
        out, "a string, b string, both_missing bigint, only_a_missing bigint, only_b_missing bigint, none_missing bigint")


def _is_missing(df: DataFrame, c: str) -> Column:
    return is_blank(c) if dict(df.dtypes)[c] == "string" else col(c).isNull()


def stacked(df: DataFrame, columns, key: str) -> DataFrame:
    """Unpivot numeric text columns to ``(column, key, v)`` with ``v`` parsed as DOUBLE."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _num(c).alias("v")) for c in columns])
    return df.select(col(key).alias(key), F.inline(pairs))


def extremes(df: DataFrame, columns, key: str, probs=(0.5, 0.99, 0.999), k: int = 5,
             exact: bool = True) -> DataFrame:
    """Per column: quantiles (``stat = p<prob>``) and the ``k`` largest non-null values (``top<rank>``).

    Rows ``(column, stat, value, key)``; ``key`` is set for the top rows only.
    """
    columns = [c for c in columns if c in df.columns]
    long = stacked(df, columns, key).filter(F.col("v").isNotNull())
    w = Window.partitionBy("column").orderBy(F.col("v").desc(), F.col(key).asc_nulls_first())
    tops = (long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("column", F.concat(F.lit("top"), F.col("rank").cast("string")).alias("stat"),
                    F.col("v").alias("value"), F.col(key).alias(key)))
    parts = [tops]
    numbers = df.select([_num(c).alias(c) for c in columns])
    values = exact_quantiles_of(numbers, {c: list(probs) for c in columns}) if exact else {}
    for c in columns:
        if exact:
            q = df.sparkSession.createDataFrame([(float(p), values[c][float(p)]) for p in probs],
                                                "probability double, value double")
        else:
            q = approx_quantiles(numbers, c, probs)
        parts.append(q.select(F.lit(c).alias("column"),
                              F.concat(F.lit("p"), F.col("probability").cast("string")).alias("stat"),
                              "value", F.lit(None).cast(df.schema[key].dataType).alias(key)))
    return reduce(DataFrame.unionByName, parts)


def score_ranges(df: DataFrame, columns, low: float = 0.0, high: float = 5.0) -> DataFrame:
    """Per score column: non-null values outside ``[low, high]`` and values equal to 0 (one scan)."""
    columns = [c for c in columns if c in df.columns]
    aggs = []
    for i, c in enumerate(columns):
        v = _num(c)
        aggs += [count_if(v.isNotNull() & ((v < low) | (v > high))).alias(f"o{i}"),
                 count_if(v == 0).alias(f"z{i}")]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"o{i}").alias("out_of_range"), F.col(f"z{i}").alias("zeros"))
        for i, c in enumerate(columns)])))


def date_order(df: DataFrame, first: str, last: str) -> DataFrame:
    a, b = safe_cast(first, "date"), safe_cast(last, "date")
    return df.agg(count_if(a > b).alias("inverted_pairs"),
                  count_if(~is_blank(first) & a.isNull()).alias(f"unparseable_{first}"))


def outside_box(df: DataFrame, bounds) -> DataFrame:
    """Rows whose coordinates are all present and not all inside their bounds."""
    present = reduce(lambda x, y: x & y, [_num(b.column).isNotNull() for b in bounds])
    inside = reduce(lambda x, y: x & y, [_num(b.column).between(float(b.low), float(b.high)) for b in bounds])
    return df.agg(count_if(present & ~inside).alias("outside_box"))


def numeric_text(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Raw (untrimmed) values made only of digits and separators."""
    return df.agg(count_if(col(column).rlike(pattern)).alias("numeric_text"))


def explore_all(df: DataFrame, config, key: str = "id", price_format: str = PRICE_FORMAT,
                counts=("beds", "bathrooms", "bedrooms", "accommodates", "minimum_nights"),
                related=("price", "price_quote_price_per_night"), exact: bool = False) -> dict[str, DataFrame]:
    """Every exploration check whose columns exist, by name (lazy DataFrames)."""
    cols = set(df.columns)
    out: dict[str, DataFrame] = {}
    price = config.price
    if price and price in cols:
        out["format_check"] = format_check(df, price, price_format)
        out["non_positive"] = non_positive(df, price)
        parsed = df.select(parse_currency(price).alias("v"))
        quantiles = exact_quantiles if exact else approx_quantiles
        out["quantiles"] = quantiles(parsed, "v", PRICE_PROBS)
        if key in cols:
            out["top_values"] = top_values(df, parse_currency(price), key)
    if set(related) <= cols:
        out["cross_missing"] = cross_missing(df, *related)
    present = [c for c in counts if c in cols]
    if present and key in cols:
        out["extremes"] = extremes(df, present, key, exact=exact)
    scores = config.score_columns(df.columns)
    if scores:
        out["score_ranges"] = score_ranges(df, scores, *config.score_range)
    if config.date_order and set(config.date_order) <= cols:
        out["date_order"] = date_order(df, *config.date_order)
    if config.box and {b.column for b in config.box} <= cols:
        out["outside_box"] = outside_box(df, config.box)
    for c in config.digit_only_text:
        if c in cols:
            out[f"numeric_text_{c}"] = numeric_text(df, c, config.digit_only_pattern)
    return out
