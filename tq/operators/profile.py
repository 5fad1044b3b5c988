"""Column profile and duplicate counts.

``profile`` computes every statistic of every column in one aggregate (one
scan, partial aggregation per task, a single-row final merge) and unpivots the
one wide row into one row per column with ``inline`` — no driver round trip.
Very wide tables are split into chunks of ``chunk`` columns so each generated
aggregate stays below the JVM method-size limit of whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    MapType,
    StringType,
    StructType,
)

from tq.functions.columns import col, count_if, is_blank, pct, text_sample
from tq.functions.frames import side_by_side


def _columns(df: DataFrame) -> list[tuple[int, str, object]]:
    """(ordinal, name, type) of every column; nested and binary ones have no numeric range and no sample."""
    return [(i, f.name, f.dataType) for i, f in enumerate(df.schema.fields)]


def comparable(c: Column, dtype) -> Column:
    """``c`` in a form that can be grouped: maps become arrays of their entries, ordered by key, at any depth."""
    if isinstance(dtype, MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            comparable(e["key"], dtype.keyType).alias("key"), comparable(e["value"], dtype.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(dtype, ArrayType):
        return F.transform(c, lambda x: comparable(x, dtype.elementType)) if _holds_map(dtype) else c
    if isinstance(dtype, StructType) and _holds_map(dtype):
        fields = [comparable(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def _holds_map(dtype) -> bool:
    if isinstance(dtype, ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, MapType)


def _comparables(df: DataFrame) -> list[Column]:
    return [comparable(col(f.name), f.dataType).alias(f"c{i}") for i, f in enumerate(df.schema.fields)]


def _numeric(name: str, dtype) -> Column:
    if isinstance(dtype, StringType):
        return col(name).try_cast("double")
    if isinstance(dtype, (IntegralType, DoubleType, FloatType, DecimalType)):
        return col(name).cast("double")
    return F.lit(None).cast("double")


def _missing(name: str, dtype) -> Column:
    return is_blank(name) if isinstance(dtype, StringType) else col(name).isNull()


def _chunks(items, size):
    for start in range(0, len(items), size):
        yield items[start:start + size]


def column_presence(df: DataFrame) -> DataFrame:
    """``(column, ordinal, non_null)`` for every column, from one aggregate."""
    names = df.columns
    wide = df.agg(*[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(names)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ordinal"), F.col(f"c{i}").alias("non_null"))
        for i, c in enumerate(names)])))


def empty_column_names(df: DataFrame) -> list[str]:
    """Names of columns without any non-null value, in schema order (one small action)."""
    rows = column_presence(df).filter(F.col("non_null") == 0).select("column", "ordinal").collect()
    return [r["column"] for r in sorted(rows, key=lambda r: r["ordinal"])]


def profile(df: DataFrame, approx: bool = True, exact_distinct: bool = False, rsd: float = 0.05,
            sample_length: int = 30, chunk: int = 100) -> DataFrame:
    """One row per column, of any type.

    Columns: ``column, ordinal, rows, missing_count, missing_pct, numeric_min,
    numeric_max, sample_value`` plus ``distinct_approx`` (HyperLogLog++, the
    raw untrimmed value, NULL ignored) and/or ``distinct_exact``.
    Missing = NULL, or blank text.  The sample is the smallest non-blank text
    (deterministic), newlines replaced, cut to ``sample_length`` characters.
    ``chunk`` columns share one aggregate: wider ones outgrow what whole-stage
    code generation compiles; it changes the plan, never the result.
    """
    cols = _columns(df)
    if not cols:
        fields = ("column string, ordinal int, rows bigint, missing_count bigint, missing_pct double, "
                  "numeric_min double, numeric_max double, sample_value string")
        fields += ", distinct_approx bigint" if approx else ""
        fields += ", distinct_exact bigint" if exact_distinct else ""
        return df.sparkSession.createDataFrame([], fields)
    parts = []
    for group in _chunks(cols, chunk):
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, name, dtype in group:
            aggs += [
                count_if(_missing(name, dtype)).alias(f"m{i}"),
                F.min(_numeric(name, dtype)).alias(f"lo{i}"),
                F.max(_numeric(name, dtype)).alias(f"hi{i}"),
                (text_sample(name, sample_length) if isinstance(dtype, StringType)
                 else F.lit(None).cast("string")).alias(f"s{i}"),
            ]
            if approx:
                aggs.append(F.approx_count_distinct(comparable(col(name), dtype), rsd).alias(f"a{i}"))
        wide = df.agg(*aggs)
        if exact_distinct:
            wide = side_by_side(wide, *[distinct_values(df, name, dtype, f"e{i}") for i, name, dtype in group])
        structs = []
        for i, name, _ in group:
            fields = [
                F.lit(name).alias("column"),
                F.lit(i).alias("ordinal"),
                F.col("rows").alias("rows"),
                F.col(f"m{i}").alias("missing_count"),
                pct(F.col(f"m{i}"), F.col("rows"), 2).alias("missing_pct"),
                F.col(f"lo{i}").alias("numeric_min"),
                F.col(f"hi{i}").alias("numeric_max"),
                F.col(f"s{i}").alias("sample_value"),
            ]
            if approx:
                fields.append(F.col(f"a{i}").alias("distinct_approx"))
            if exact_distinct:
                fields.append(F.col(f"e{i}").alias("distinct_exact"))
            structs.append(F.struct(*fields))
        parts.append(wide.select(F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, parts)


def distinct_values(df: DataFrame, name: str, dtype, alias: str) -> DataFrame:
    """One row: number of different non-null values.  One column is read and grouped (combined map-side); several
    ``count(DISTINCT)`` in one aggregate would send every row once per column through the shuffle instead."""
    values = df.select(comparable(col(name), dtype).alias("v")).filter(F.col("v").isNotNull()).distinct()
    return values.agg(F.count(F.lit(1)).alias(alias))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row ``duplicate_rows``: rows minus distinct rows (grouped, combined map-side)."""
    per_row = df.groupBy(*_comparables(df)).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row ``duplicate_keys``: rows minus distinct key values (NULL is one value)."""
    per_key = df.groupBy(col(key)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_keys"))


def table_summary(df: DataFrame, key: str | None = None) -> DataFrame:
    """One row: ``rows, columns, duplicate_rows[, duplicate_keys]``.

    The row count comes from the whole-row grouping (sum of group sizes), so the
    table is scanned once for rows and duplicates, plus once per key.
    """
    per_row = df.groupBy(*_comparables(df)).agg(F.count(F.lit(1)).alias("n"))
    main = per_row.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
                       F.lit(len(df.columns)).alias("columns"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    if key and key in df.columns:
        return side_by_side(main, duplicate_keys(df, key))
    return main
