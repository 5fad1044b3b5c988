"""Profiles kept as mergeable state: one slice (a day, a file) is read once, later questions need the state only.

State of a slice, two small tables partitioned by ``slice``:

* ``columns``: per column rows, missing values, numeric range, a HyperLogLog sketch of the
  distinct values and a KLL sketch of the numbers (Spark's own sketch aggregates);
* ``buckets``: per column how many values are missing, numbers or other text, by
  bucket. The buckets are fixed by a rule (leading digit and power of ten of a
  number, hash of a text), not by the data, so the counts of any two slices add up.

``add_slice`` profiles a new slice and writes its partition; a slice that is written
again (a retried day) replaces itself. ``merged_profile`` answers for any set of slices
from their sketches; ``drift`` compares two of them by Kolmogorov-Smirnov distance,
population stability index and missing share, without reading a table again.

Bounds of the merged sketches: distinct counts have a relative standard deviation of
1.04 / sqrt(2 ** LG_K) = 1.6 %, ranks of quantiles an error below 1.7 % (KLL, k = 200,
99 % confidence); counts, ranges and buckets are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tq.functions.columns import col, count_if, pct
from tq.operators.profile import _columns, _missing, _numeric
from tq.operators.spread import finite

LG_K, KLL_K = 12, 200
#: Powers of ten that are told apart, and buckets of other text.
LOW_POWER, HIGH_POWER, TEXT_BUCKETS = -6, 12, 256
MISSING, NUMBER, TEXT = "missing", "number", "text"
#: Drift is reported above these (the usual reading of the index; a tenth of the distribution moved).
PSI_LIMIT, KS_LIMIT = 0.2, 0.1

COLUMNS_SCHEMA = ("column string, ordinal int, rows bigint, missing bigint, numbers bigint, low double, high double, "
                  "distinct_sketch binary, number_sketch binary, slice string")
BUCKETS_SCHEMA = "column string, kind string, bucket int, n bigint, slice string"


def number_bucket(v: Column) -> Column:
    """0 for 0; else +/- (9 * power of ten + leading digit), powers from 10**LOW_POWER to 10**HIGH_POWER."""
    size = F.abs(v)
    power = F.greatest(F.lit(LOW_POWER), F.least(F.lit(HIGH_POWER), F.floor(F.log10(size))))
    digit = F.greatest(F.lit(1), F.least(F.lit(9), F.floor(size / F.pow(F.lit(10.0), power.cast("double")))))
    index = ((power - LOW_POWER) * 9 + digit).cast("int")
    return F.when(v == 0, F.lit(0)).when(v < 0, -index).otherwise(index)


def text_bucket(c: Column, kind: str) -> Column:
    if kind == "xxhash64":
        return F.pmod(F.xxhash64(c), F.lit(TEXT_BUCKETS)).cast("int")
    if kind == "md5":
        return F.conv(F.substring(F.md5(c.cast("binary")), 1, 2), 16, 10).cast("int")
    raise ValueError(f"unknown hash {kind!r}")


def column_state(df: DataFrame) -> DataFrame:
    """The ``columns`` rows of a table: one aggregate over one scan."""
    items = _columns(df)
    # each value is typed once, not in every aggregate that takes it
    typed = [x for i, name, dtype in items for x in (_missing(name, dtype).alias(f"m{i}"), _numeric(name, dtype).alias(f"v{i}"),
                                                     (col(name) if isinstance(dtype, StringType) else col(name).cast("string")).alias(f"s{i}"))]
    df = df.select(*typed)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, _, _ in items:
        v, shown = F.when(finite(F.col(f"v{i}")), F.col(f"v{i}")), F.col(f"s{i}")
        aggs += [count_if(F.col(f"m{i}")).alias(f"m{i}"), F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                 # the sketch passes over empty texts, so every text gets a sign ahead
                 F.hll_sketch_agg(F.concat(F.lit("="), shown), F.lit(LG_K)).alias(f"d{i}"), F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias(f"q{i}")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(name).alias("column"), F.lit(i).alias("ordinal"), F.col("rows"), F.col(f"m{i}").alias("missing"), F.col(f"n{i}").alias("numbers"),
                        F.col(f"lo{i}").alias("low"), F.col(f"hi{i}").alias("high"), F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("number_sketch"))
               for i, name, _ in items]
    return wide.select(F.inline(F.array(*structs)))


def bucket_state(df: DataFrame, text_hash: str = "xxhash64") -> DataFrame:
    """The ``buckets`` rows of a table: a grouped count, combined in each task to a few hundred rows per column."""
    # a cell is judged after it has become a row: one expression for all columns, which the JVM compiles, not one for each
    cells = [F.struct(F.lit(name).alias("column"), _missing(name, dtype).alias("missing"), _numeric(name, dtype).alias("v"),
                      col(name).cast("string").alias("text")) for _, name, dtype in _columns(df)]
    v, missing = F.col("v"), F.col("missing")
    number = finite(v)
    kind = F.when(missing, F.lit(MISSING)).when(number, F.lit(NUMBER)).otherwise(F.lit(TEXT))
    bucket = F.when(missing, F.lit(0)).when(number, number_bucket(v)).otherwise(text_bucket(F.col("text"), text_hash))
    judged = df.select(F.inline(F.array(*cells))).select("column", kind.alias("kind"), bucket.alias("bucket"))
    return judged.groupBy("column", "kind", "bucket").agg(F.count(F.lit(1)).alias("n"))


def add_slice(df: DataFrame, path: str, name: str, text_hash: str = "xxhash64") -> None:
    """Profiles ``df`` and writes its state as slice ``name``; one that exists is replaced, others are not touched."""
    for part, state in (("columns", column_state(df)), ("buckets", bucket_state(df, text_hash))):
        state.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{part}/slice={name}")


def _state(spark: SparkSession, path: str, part: str, slices) -> DataFrame:
    rows = spark.read.schema(COLUMNS_SCHEMA if part == "columns" else BUCKETS_SCHEMA).option("basePath", f"{path.rstrip('/')}/{part}")
    rows = rows.parquet(f"{path.rstrip('/')}/{part}")
    return rows if slices is None else rows.filter(F.col("slice").isin(*slices))


def quantile_name(p: float) -> str:
    return f"q{p:g}".replace(".", "_")


def merged_profile(spark: SparkSession, path: str, slices=None, probs=(0.5, 0.99)) -> DataFrame:
    """One row per column over all (or the given) slices: ``column, rows, missing_count, missing_pct, numeric_min,
    numeric_max, distinct_approx, q0_5..``, from the saved state alone."""
    s = _state(spark, path, "columns", slices)
    out = s.groupBy("column").agg(
        F.min("ordinal").alias("ordinal"), F.sum("rows").alias("rows"), F.sum("missing").alias("missing_count"), F.sum("numbers").alias("numbers"),
        F.min("low").alias("numeric_min"), F.max("high").alias("numeric_max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_approx"),
        # a column without numbers has an empty sketch, which has no quantiles
        F.kll_merge_agg_double(F.when(F.col("numbers") > 0, F.col("number_sketch"))).alias("sketch"))
    quantiles = [F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(quantile_name(p)) for p in probs]
    return out.select("column", "ordinal", "rows", "missing_count", pct(F.col("missing_count"), F.col("rows"), 2).alias("missing_pct"),
                      "numeric_min", "numeric_max", "distinct_approx", *quantiles)


def distances(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per column of two ``buckets`` tables: ``column, rows_a, rows_b, missing_pct_a, missing_pct_b, ks, psi, drifted``.

    ``ks``: largest difference of the cumulative shares of the numbers (NULL unless both sides have some); ``psi``:
    sum of (p - q) ln(p / q) over all buckets that either side has, with half a value added to each.
    """
    both = before.select("column", "kind", "bucket", F.col("n").alias("a"), F.lit(0).cast("bigint").alias("b")).unionByName(
        after.select("column", "kind", "bucket", F.lit(0).cast("bigint").alias("a"), F.col("n").alias("b")))
    both = both.groupBy("column", "kind", "bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    column = Window.partitionBy("column")
    # a column has a few hundred buckets at most, whatever its rows
    order = Window.partitionBy("column", "kind").orderBy("bucket")
    kind = Window.partitionBy("column", "kind")
    for s in ("a", "b"):
        both = both.withColumn(f"rows_{s}", F.sum(s).over(column)).withColumn(f"of_{s}", F.sum(s).over(kind)).withColumn(f"upto_{s}", F.sum(s).over(order))
    both = both.withColumn("kinds", F.count(F.lit(1)).over(column))
    share = lambda s: (F.col(s) + 0.5) / (F.col(f"rows_{s}") + 0.5 * F.col("kinds"))
    gap = F.when((F.col("kind") == NUMBER) & (F.col("of_a") > 0) & (F.col("of_b") > 0),
                 F.abs(F.col("upto_a") / F.col("of_a") - F.col("upto_b") / F.col("of_b")))
    missing = lambda s: F.sum(F.when(F.col("kind") == MISSING, F.col(s)).otherwise(0))
    out = both.groupBy("column").agg(
        F.max("rows_a").alias("rows_a"), F.max("rows_b").alias("rows_b"), missing("a").alias("miss_a"), missing("b").alias("miss_b"),
        F.round(F.max(gap), 6).alias("ks"), F.round(F.sum((share("a") - share("b")) * F.log(share("a") / share("b"))), 6).alias("psi"))
    drifted = (F.col("psi") > PSI_LIMIT) | F.coalesce(F.col("ks") > KS_LIMIT, F.lit(False))
    return out.select("column", "rows_a", "rows_b", pct(F.col("miss_a"), F.col("rows_a"), 2).alias("missing_pct_a"),
                      pct(F.col("miss_b"), F.col("rows_b"), 2).alias("missing_pct_b"), "ks", "psi", drifted.alias("drifted"))


def drift(spark: SparkSession, path: str, before, after) -> DataFrame:
    """``distances`` of two sets of saved slices."""
    fold = lambda slices: _state(spark, path, "buckets", list(slices)).groupBy("column", "kind", "bucket").agg(F.sum("n").alias("n"))
    return distances(fold(before), fold(after))
