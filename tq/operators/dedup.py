"""Deterministic removal of duplicate keys.

Survivor of a key = the row that is smallest on all other columns (schema
order, NULL first, NaN last) — the same row a
``row_number() OVER (PARTITION BY key ORDER BY <others> NULLS FIRST) = 1``
would keep.  Keys are nearly always unique, so the whole rows are not grouped:

1. a hash aggregate over the key column alone finds the repeated keys, which are
   written once and counted (Spark sees the size of the aggregate's input only, so
   it would sort every row by its key for a handful of repeated ones);
2. rows of all other keys pass through an anti join with them, unsorted: the
   repeated keys are broadcast while they are few, beyond that both sides are
   shuffled and the keys, not the rows, are hashed;
3. only rows of repeated keys reach the survivor aggregate, ``min(struct(<others>))``
   per key, which is combined map-side: a key that holds a third of the table
   reaches the reducer as one partial row per map task.

Rows with a NULL key are never merged (they are invalid and go to quarantine);
a filter-only branch keeps them out of the joins.  Everything is deterministic,
so a task re-run after an executor loss produces exactly the same rows.  The
input is read once per branch and must not change in between: stage volatile
sources (JDBC, files being overwritten) to Parquet first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tq.functions import frames
from tq.functions.columns import col
from tq.session import materialize

_SURVIVOR = "__tq_survivor"


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The non-null keys that occur more than once (one column, ``key``)."""
    return (df.filter(col(key).isNotNull()).groupBy(col(key)).agg(F.count(F.lit(1)).alias("__n"))
            .filter(F.col("__n") > 1).drop("__n"))


def dedup_by_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Keep one row per non-null ``key``; keep every row whose key is NULL.

    ``order``: columns that decide the survivor (default: all others, schema order).
    """
    if key not in df.columns:
        return df
    columns = df.columns
    others = [c for c in columns if c != key]
    order = list(order) if order else others
    rest = [c for c in others if c not in order]
    with_key = df.filter(col(key).isNotNull())
    without_key = df.filter(col(key).isNull())
    if not others:
        return with_key.distinct().unionByName(without_key)
    repeated = materialize(repeated_keys(df, key))
    repeated = frames.hashed_side(repeated, repeated.count())
    single = with_key.join(repeated, key, "left_anti").select([col(c) for c in columns])
    packed = F.struct(*[col(c).alias(f"f{i}") for i, c in enumerate(order + rest)])
    grouped = with_key.join(repeated, key, "left_semi").groupBy(col(key)).agg(F.min(packed).alias(_SURVIVOR))
    fields = {c: F.col(f"{_SURVIVOR}.f{i}").alias(c) for i, c in enumerate(order + rest)}
    survivors = grouped.select([col(key) if c == key else fields[c] for c in columns])
    return single.unionByName(survivors).unionByName(without_key)


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """One row: rows with a non-null key minus distinct non-null keys."""
    per_key = df.filter(col(key).isNotNull()).groupBy(col(key)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
