"""Quantiles: Spark's approximate summary, and an exact distributed selection.

``approx_quantiles`` is ``percentile_approx`` (the Greenwald-Khanna summary
behind ``DataFrame.approxQuantile``), with accuracy ``1 / relative_error``.

``exact_quantiles`` returns the discrete quantile (``percentile_disc``: the
value at 1-based rank ``ceil(p * n)``) without gathering the column in one
task.  A first aggregate brackets every probability by the approximate
summary; each further one sorts the rows of the open brackets into ``buckets``
equal-width buckets (on a log-scaled axis, so skewed data narrows as fast as
uniform data) and returns count, min and max per bucket — at most
``len(probs) * (buckets + 1)`` rows per column reach the driver.  The bucket
holding the target rank becomes the next bracket; a bucket whose min equals
its max is the answer.  Realistic columns need one or two such passes, for any
number of columns and probabilities together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tq.functions.columns import count_if

QUANTILE_SCHEMA = StructType([StructField("probability", DoubleType(), False),
                              StructField("value", DoubleType(), True)])


def _scaled(v: Column) -> Column:
    """Monotonic log-scaled axis: sign(v) * ln(1 + |v|)."""
    return F.signum(v) * F.log1p(F.abs(v))


def _axis(x: float) -> float:
    return math.copysign(math.log1p(abs(x)), x)


def approx_quantiles(df: DataFrame, column: str, probs, relative_error: float = 0.001) -> DataFrame:
    accuracy = max(1, int(round(1.0 / relative_error)))
    v = F.col(column).cast("double")
    agg = df.agg(F.percentile_approx(v, list(map(float, probs)), accuracy).alias("q"))
    return agg.select(F.inline(F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("probability"),
                                            F.col("q").alias("value"))))


def _is_finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(math.inf))


def exact_quantiles_of(df: DataFrame, wanted: dict[str, list[float]], buckets: int = 1024,
                       accuracy: int = 1000) -> dict[str, dict[float, float | None]]:
    """``{column: {p: value}}`` for all columns and probabilities together.

    One aggregate counts each column's -inf, finite, +inf and NaN values (in that order they sort, NULLs
    are ignored) and brackets every probability by ``percentile_approx``; each further aggregate cuts every
    open bracket into ``buckets`` and keeps the one that holds the rank.  A bracket always loses its lowest
    or its highest value, so the loop ends; one that misses its rank starts again from the full range.
    """
    names = list(wanted)
    data = df.select([F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    aggs = []
    for i, c in enumerate(names):
        v = F.col(f"v{i}")
        finite = F.when(_is_finite(v), v)
        near = [min(1.0, max(0.0, float(p) + d)) for p in wanted[c] for d in (-2.0 / accuracy, 2.0 / accuracy)]
        aggs += [F.count(finite).alias(f"n{i}"), count_if(v == F.lit(-math.inf)).alias(f"neg{i}"),
                 count_if(v == F.lit(math.inf)).alias(f"pos{i}"), count_if(F.isnan(v)).alias(f"nan{i}"),
                 F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
        if near:
            aggs.append(F.percentile_approx(finite, near, accuracy).alias(f"near{i}"))
    stats = data.agg(*aggs).first() if names else None
    result: dict[str, dict[float, float | None]] = {c: {} for c in names}
    open_: dict[tuple[int, float], tuple[float, float, int]] = {}   # (column, p) -> low, high, rank among finite values
    for i, c in enumerate(names):
        n, neg, pos, nan = (stats[f"{k}{i}"] for k in ("n", "neg", "pos", "nan"))
        total = n + neg + pos + nan
        for j, p in enumerate(map(float, wanted[c])):
            rank = max(1, math.ceil(p * total)) - 1 - neg
            if total == 0:
                result[c][p] = None
            elif 0 <= rank < n:
                open_[i, p] = (stats[f"near{i}"][2 * j], stats[f"near{i}"][2 * j + 1], rank)
            else:
                result[c][p] = -math.inf if rank < 0 else math.inf if rank < n + pos else math.nan
    while open_:
        probes = list(open_.items())
        items = []
        for k, ((i, _), (lo, hi, _rank)) in enumerate(probes):
            v = F.col(f"v{i}")
            a, b = _axis(lo), _axis(hi)
            if lo == hi:
                bucket = F.lit(0)
            elif b > a:
                bucket = F.floor((_scaled(v) - F.lit(a)) / F.lit(b - a) * F.lit(buckets))
            else:  # log axis collapsed (huge, very close values): linear axis, halved against overflow
                bucket = F.floor((v / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) * F.lit(buckets))
            bucket = F.greatest(F.lit(0), F.least(F.lit(buckets - 1), bucket.cast("int")))
            where = F.when(v < F.lit(lo), F.lit(-1)).when(v <= F.lit(hi), bucket)
            items.append(F.when(_is_finite(v) & (v <= F.lit(hi)),
                                F.struct(F.lit(k).alias("probe"), where.alias("bucket"), v.alias("v"))))
        hist = (data.select(F.explode(F.array_compact(F.array(*items))).alias("x"))
                .groupBy(F.col("x.probe").alias("probe"), F.col("x.bucket").alias("bucket"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi")).collect())
        for k, ((i, p), (_, _, rank)) in enumerate(probes):
            left, found = rank, None
            for r in sorted((r for r in hist if r["probe"] == k), key=lambda r: r["bucket"]):
                if left < r["n"]:
                    found = r
                    break
                left -= r["n"]
            if found is None or found["bucket"] < 0:
                open_[i, p] = (stats[f"lo{i}"], stats[f"hi{i}"], rank)
            elif found["lo"] == found["hi"]:
                result[names[i]][p] = found["lo"]
                del open_[i, p]
            else:
                open_[i, p] = (found["lo"], found["hi"], rank)
    return result


def exact_quantile_values(df: DataFrame, column: str, probs, **kw) -> dict[float, float | None]:
    """``{p: value}`` of one column."""
    return exact_quantiles_of(df, {column: list(probs)}, **kw)[column]


def exact_quantiles(df: DataFrame, column: str, probs, **kw) -> DataFrame:
    """``(probability, value)`` rows of the exact discrete quantiles."""
    values = exact_quantile_values(df, column, probs, **kw)
    return df.sparkSession.createDataFrame([(float(p), values[float(p)]) for p in probs], QUANTILE_SCHEMA)
