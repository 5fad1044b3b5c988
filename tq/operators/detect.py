"""Detection measurement: how many injected errors did cleaning catch?

An injected error counts as detected when its row is quarantined with the
expected reason, when the corrupted value was set to NULL in the clean table,
or — for duplicated rows — by the growth of the removed-duplicate count over
the baseline run.  All lookups are joins on the typed key; the assignments
side is bounded by ``n`` per type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tq.functions.columns import count_if
from tq.functions.frames import bounded_broadcast, side_by_side
from tq.operators.clean import CleanResult
from tq.operators.inject import ERROR_TYPE, ErrorType
from tq.operators.rules import REASONS


def kept_rows(result: CleanResult) -> DataFrame:
    """One row ``kept``: rows left after dedup."""
    return result.reasoned.agg(F.count(F.lit(1)).alias("kept"))


def duplicates_removed(result: CleanResult, name: str) -> DataFrame:
    return kept_rows(result).select((F.lit(result.prepass.rows_in) - F.col("kept")).alias(name))


def injected_rows(after: CleanResult, assignments: DataFrame, key: str, max_assigned: int) -> DataFrame:
    """``(__k, error_type, __r)``: each injected key with the reasons of its row (NULL where no row is left)."""
    a = assignments.select(F.col(key).alias("__k"), F.col(ERROR_TYPE).alias(ERROR_TYPE))
    rows = after.reasoned.select(F.col(key).alias("__k"), F.col(REASONS).alias("__r"))
    return a.join(rows.join(bounded_broadcast(a.select("__k"), max_assigned), "__k", "left_semi"), "__k", "left")


def recall(after: CleanResult, assignments: DataFrame, types: list[ErrorType], key: str,
           baseline: CleanResult, max_assigned: int) -> DataFrame:
    """One row per used type: ``error_type, description, injected, detected, recall_pct``.

    ``max_assigned`` is the proven bound of the assignments (``n`` x number of types).
    """
    spark = assignments.sparkSession
    registry = spark.createDataFrame(
        [(t.name, t.description, *t.trace, i) for i, t in enumerate(types)],
        "error_type string, description string, detection string, target string, ordinal int")
    nullable = {t.trace[1] for t in types if t.trace[0] == "null"}
    rows = after.reasoned.select(F.col(key).alias("__k"), F.col(REASONS).alias("__r"),
                                 *[F.col(c).isNull().alias(f"__null_{c}") for c in sorted(nullable)])
    a = assignments.select(F.col(key).alias("__k"), F.col(ERROR_TYPE).alias(ERROR_TYPE))
    # the big side is first cut to the injected keys by a broadcast semi join (assignments: n per type)
    rows = rows.join(bounded_broadcast(a.select("__k"), max_assigned), "__k", "left_semi")
    a = a.join(bounded_broadcast(registry, len(types)), ERROR_TYPE)
    nulled = F.lit(False)
    for c in sorted(nullable):
        nulled = F.when(F.col("target") == c, F.col(f"__null_{c}")).otherwise(nulled)
    hit = (F.when(F.col("detection") == "reason", F.coalesce(F.array_contains("__r", F.col("target")), F.lit(False)))
           .when(F.col("detection") == "null", (F.size("__r") == 0) & F.coalesce(nulled, F.lit(False)))
           .otherwise(F.lit(False)))
    # rows of ``after`` are unique per non-null key (dedup), so a left join keeps one row per injected key
    per_type = (a.join(rows, "__k", "left")
                .groupBy(ERROR_TYPE, "description", "detection", "ordinal")
                .agg(F.count(F.lit(1)).alias("injected"), count_if(hit).alias("detected")))
    # duplicated rows are credited by the growth of removed duplicates over the baseline run;
    # the one-row growth is unioned in and folded per type (no join on a constant)
    dup_names = [t.name for t in types if t.trace[0] == "removal"]
    if dup_names:
        extra = side_by_side(duplicates_removed(after, "dups_after"), duplicates_removed(baseline, "dups_before"))
        growth = extra.select(F.explode(F.array(*[F.lit(n) for n in dup_names])).alias(ERROR_TYPE),
                              (F.col("dups_after") - F.col("dups_before")).alias("growth"))
        per_type = per_type.unionByName(growth, allowMissingColumns=True).groupBy(ERROR_TYPE).agg(
            *[F.max(c).alias(c) for c in ("description", "detection", "ordinal", "injected", "detected", "growth")])
    else:
        per_type = per_type.withColumn("growth", F.lit(None).cast("bigint"))
    detected = F.when(F.col("detection") == "removal", F.least(F.col("injected"), F.col("growth"))) \
        .otherwise(F.col("detected")).cast("bigint")
    return per_type.select(ERROR_TYPE, "description", F.col("injected").cast("bigint").alias("injected"),
                           detected.alias("detected"), "ordinal") \
        .withColumn("recall_pct", F.round(F.lit(100.0) * F.col("detected") / F.col("injected"), 1))


def overall(per_type: DataFrame) -> DataFrame:
    """One row: ``total_injected, total_detected, overall_recall_pct``."""
    return per_type.agg(F.sum("injected").cast("bigint").alias("total_injected"),
                        F.sum("detected").cast("bigint").alias("total_detected")) \
        .withColumn("overall_recall_pct",
                    F.round(F.lit(100.0) * F.col("total_detected") / F.nullif(F.col("total_injected"), F.lit(0)), 1))


def collateral(after: CleanResult, assignments: DataFrame, baseline: CleanResult, key: str,
               max_assigned: int) -> DataFrame:
    """One row ``collateral_rows``: distinct quarantined keys neither injected nor quarantined before."""
    rejected = after.rejected.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    before = baseline.rejected.select(F.col(key)).filter(F.col(key).isNotNull())
    injected = assignments.select(F.col(key))
    left = rejected.join(bounded_broadcast(injected, max_assigned), key, "left_anti").join(before, key, "left_anti")
    return left.agg(F.count(F.lit(1)).alias("collateral_rows"))
