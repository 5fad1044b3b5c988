"""Expectations on a stream: partial counts per micro-batch, added up to a running suite result.

Each micro-batch writes its own partition, ``batch=<id>``: one wide row of counts for the
row-level rules, and for each uniqueness rule the batch's values (as 128-bit digests)
with their counts. A batch that is tried again after a failure replaces its own
partition, so every row counts exactly once. ``running_result`` adds the partitions up;
it equals ``evaluate`` on the whole table. ``compact`` folds finished batches into one,
so the state of a long stream is one row per distinct value, not per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tq.functions.columns import col, count_if
from tq.functions.frames import side_by_side
from tq.operators.expect import Rule, _results
from tq.sources.files import exists, remove

VALUES_SCHEMA = "ordinal int, a bigint, b bigint, n bigint"


def _plain(rules: list[Rule]) -> list[tuple[int, object]]:
    return [(i, e) for i, (_, e) in enumerate(rules) if not e.grouped]


def _counts_schema(rules: list[Rule]) -> str:
    return ", ".join(["rows bigint", *[f"u{i} bigint, d{i} bigint" for i, _ in _plain(rules)]])


def batch_counts(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, e in _plain(rules):
        aggs += [count_if(e.unexpected()).alias(f"u{i}"), count_if(e.denominator()).alias(f"d{i}")]
    return rows.agg(*aggs)


def batch_values(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``(ordinal, a, b, n)``: the non-null values of the uniqueness rules' columns by digest, combined in each task."""
    items = [F.struct(F.lit(i).alias("ordinal"), F.xxhash64(F.lit(1), col(e.column)).alias("a"), F.xxhash64(F.lit(2), col(e.column)).alias("b"),
                      col(e.column).isNotNull().alias("some")) for i, (_, e) in enumerate(rules) if e.grouped]
    if not items:
        return rows.sparkSession.createDataFrame([], VALUES_SCHEMA)
    return rows.select(F.inline(F.array(*items))).filter("some").groupBy("ordinal", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def write_batch(rows: DataFrame, rules: list[Rule], path: str, batch: int) -> None:
    rows = rows.persist()
    try:
        batch_counts(rows, rules).write.mode("overwrite").parquet(f"{path}/counts/batch={batch}")
        batch_values(rows, rules).write.mode("overwrite").parquet(f"{path}/values/batch={batch}")
    finally:
        rows.unpersist()


def start_validation_stream(stream: DataFrame, rules: list[Rule], path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Writes the partial counts of every micro-batch of ``stream`` (typed rows) under ``path``."""
    writer = stream.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, rules, path, batch)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _read(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    folder = f"{path}/{part}"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch int").parquet(folder)


def running_result(spark: SparkSession, path: str, rules: list[Rule]) -> DataFrame:
    """The suite's result over all batches written so far, one row per rule."""
    counts = _read(spark, path, "counts", _counts_schema(rules))
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns if c != "batch"])
    values = _read(spark, path, "values", VALUES_SCHEMA).groupBy("ordinal", "a", "b").agg(F.sum("n").alias("n"))
    frames = [sums]
    for i, (_, e) in enumerate(rules):
        if e.grouped:
            mine = values.filter(F.col("ordinal") == i)
            frames.append(mine.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias(f"u{i}"),
                                   F.coalesce(F.sum("n"), F.lit(0)).alias(f"d{i}")))
    return _results(side_by_side(*frames) if len(frames) > 1 else sums, rules)


def compact(spark: SparkSession, path: str, rules: list[Rule]) -> None:
    """Folds all batches written so far into the last of them; call it while the stream is stopped.

    The folded tables are written beside the batches first and take their place then; a run that breaks
    off in between is finished by the next call.
    """
    for part, schema in (("counts", _counts_schema(rules)), ("values", VALUES_SCHEMA)):
        folded = f"{path}/folded-{part}"
        if not exists(spark, f"{folded}/_SUCCESS"):
            rows = _read(spark, path, part, schema)
            if "batch" not in rows.columns or rows.isEmpty():
                continue
            last = rows.agg(F.max("batch")).first()[0]
            keys = [c for c in ("ordinal", "a", "b") if c in rows.columns]
            sums = [F.sum(c).alias(c) for c in rows.columns if c not in (*keys, "batch")]
            (rows.groupBy(*keys).agg(*sums) if keys else rows.agg(*sums)).withColumn("last", F.lit(last)).write.mode("overwrite").parquet(folded)
        kept = spark.read.parquet(folded)
        last = kept.agg(F.max("last")).first()[0]
        remove(spark, f"{path}/{part}")
        kept.drop("last").write.mode("overwrite").parquet(f"{path}/{part}/batch={last}")
        remove(spark, folded)
