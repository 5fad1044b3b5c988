"""Clean + quarantine.

Plan per run (independent of the number of columns and rules):

1. one pre-pass aggregate over the normalised text (one Spark job, one result
   row): row count, non-null count per column (fully empty columns),
   conversion losses, score zeros and digit-only texts — every count the log
   needs before values are changed;
2. one lazy plan: typed/repaired projection -> dedup (only repeated keys are
   grouped) -> reasons column.  ``clean`` and ``rejected`` are two filters of
   it; ``save()`` writes it once, partitioned by the quarantine flag, so both
   outputs come from a single pass;
3. metrics: the pre-pass values plus one aggregate over the reasoned rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tq.config import LISTINGS, QualityConfig
from tq.functions.columns import col, count_if, digit_only
from tq.operators.dedup import dedup_by_key
from tq.operators.normalize import cast_plan, normalize, typed_projection, typed_value
from tq.operators.rules import REASON_TEXT, REASONS, reason_text, reasons_column, row_rules
from tq.sources.files import read_partitioned

QUARANTINED = "quarantined"
DUPLICATES = "duplicate_keys_removed"

METRICS_SCHEMA = StructType([
    StructField("metric", StringType(), False),
    StructField("key", StringType(), True),
    StructField("value", LongType(), True),
])


@dataclass
class PrePass:
    """Counts taken on the normalised text before any value is changed."""

    rows_in: int
    non_null: dict[str, int]
    lost: dict[str, int]
    score_zeros: int
    digit_only: dict[str, int]
    empty_columns: list[str] = field(default_factory=list)
    columns: list[str] = field(default_factory=list)


@dataclass
class CleanResult:
    reasoned: DataFrame   # typed, deduplicated rows with the ``reject_reasons`` array
    prepass: PrePass
    config: QualityConfig

    @property
    def _partitioned(self) -> bool:
        return QUARANTINED in self.reasoned.columns

    @property
    def clean(self) -> DataFrame:
        if self._partitioned:   # saved table: the filter prunes the quarantine partition away
            return self.reasoned.filter(~F.col(QUARANTINED)).drop(REASONS, QUARANTINED)
        return self.reasoned.filter(F.size(REASONS) == 0).drop(REASONS)

    @property
    def rejected(self) -> DataFrame:
        rows = self.reasoned.filter(F.col(QUARANTINED)).drop(QUARANTINED) if self._partitioned \
            else self.reasoned.filter(F.size(REASONS) > 0)
        return rows.withColumn(REASON_TEXT, reason_text(REASONS)).drop(REASONS)

    @property
    def _rules(self) -> list[str]:
        """Every reason that the rules can give, in rule order (known when planning)."""
        later = [r.reason for r in self.config.ratios] + ([self.config.nearby.reason] if self.config.nearby else [])
        return [r.reason for r in row_rules(self.config, self.reasoned.columns)] + later

    def _counts(self) -> DataFrame:
        """One wide row: rows kept, clean rows, and rows per reason (``r<i>``): one aggregate, no shuffle of rows."""
        return self.reasoned.agg(
            F.count(F.lit(1)).alias("kept"), count_if(F.size(REASONS) == 0).alias("clean"),
            *[count_if(F.array_contains(REASONS, r)).alias(f"r{i}") for i, r in enumerate(self._rules)])

    def _reason_items(self):
        return [F.struct(F.lit(r).alias("reason"), F.col(f"r{i}").alias("n")) for i, r in enumerate(self._rules)]

    def reason_counts(self) -> DataFrame:
        """``(reason, n)``: one row per reason that occurs; a row with two reasons counts in both."""
        items = self._reason_items()
        if not items:
            return self.reasoned.sparkSession.createDataFrame([], "reason string, n bigint")
        return self._counts().select(F.inline(F.array(*items))).filter(F.col("n") > 0)

    def metrics(self) -> DataFrame:
        """Long log ``(metric, key, value)``: pre-pass counts plus one aggregate over the reasoned rows."""
        p = self.prepass
        rows = [("rows_in", None, p.rows_in)]
        # value = position of the dropped column in the input schema
        rows += [("dropped_empty_columns", c, p.columns.index(c)) for c in p.empty_columns]
        rows += [("values_lost_in_conversion", c, n) for c, n in p.lost.items() if n]
        rows += [("score_zeros_set_to_null", None, p.score_zeros)]
        rows += [("numeric_text_set_to_null", c, n) for c, n in p.digit_only.items()]
        fixed = self.reasoned.sparkSession.createDataFrame(rows, METRICS_SCHEMA)

        def item(metric, key, value):
            return F.struct(F.lit(metric).alias("metric"), F.lit(key).cast("string").alias("key"),
                            value.cast("bigint").alias("value"))

        items = [item("rows_clean", None, F.col("clean")),
                 item("rows_quarantined", None, F.col("kept") - F.col("clean")),
                 item(DUPLICATES, None, F.lit(p.rows_in) - F.col("kept"))]
        items += [item("quarantine_reasons", r, F.col(f"r{i}")) for i, r in enumerate(self._rules)]
        counted = self._counts().select(F.inline(F.array(*items)))
        return fixed.unionByName(counted.filter((F.col("metric") != "quarantine_reasons") | (F.col("value") > 0)))

    def log(self) -> dict:
        """The cleaning log as a small dict, one entry per metric."""
        p = self.prepass
        m = {(r["metric"], r["key"]): r["value"] for r in self.metrics().collect()}
        reasons = {k: v for (metric, k), v in m.items() if metric == "quarantine_reasons"}
        return {
            "rows_in": p.rows_in,
            "dropped_empty_columns": list(p.empty_columns),
            "values_lost_in_conversion": {c: n for c, n in p.lost.items() if n},
            "score_zeros_set_to_null": p.score_zeros,
            "numeric_text_set_to_null": dict(p.digit_only),
            "duplicate_keys_removed": m[(DUPLICATES, None)],
            "rows_clean": m[("rows_clean", None)],
            "rows_quarantined": m[("rows_quarantined", None)],
            "quarantine_reasons": reasons,
        }

    def save(self, path: str, mode: str = "overwrite") -> "CleanResult":
        """Write the reasoned rows once, partitioned by ``quarantined``, and continue from the files.

        One pass produces both outputs; later actions read Parquet with partition
        pruning instead of recomputing dedup (this also cuts the lineage).
        """
        out = self.reasoned.withColumn(QUARANTINED, F.size(REASONS) > 0)
        out.write.mode(mode).partitionBy(QUARANTINED).parquet(path)
        reread = read_partitioned(self.reasoned.sparkSession, path, QUARANTINED, out.schema)
        return CleanResult(reread.select(*self.reasoned.columns, QUARANTINED), self.prepass, self.config)


def prepass_columns(norm: DataFrame, config: QualityConfig):
    """Aggregate expressions of the pre-pass (all in one ``agg``)."""
    columns = norm.columns
    casts = cast_plan(config, columns)
    exprs = [F.count(F.lit(1)).alias("rows_in")]
    exprs += [F.count(col(c)).alias(f"nn{i}") for i, c in enumerate(columns)]
    exprs += [count_if(col(c).isNotNull() & typed_value(c, t, config).isNull()).alias(f"lost{i}")
              for i, (c, t) in enumerate(casts.items())]
    scores = config.score_columns(columns)
    zero_terms = [count_if(typed_value(c, "double", config) == F.lit(0.0)) for c in scores]
    exprs.append((sum(zero_terms[1:], zero_terms[0]) if zero_terms else F.lit(0)).cast("bigint").alias("zeros"))
    text = [c for c in config.digit_only_text if c in columns]
    exprs += [count_if(digit_only(c, config.digit_only_pattern)).alias(f"digits{i}") for i, c in enumerate(text)]
    return exprs, casts, text


def run_prepass(norm: DataFrame, config: QualityConfig) -> PrePass:
    exprs, casts, text = prepass_columns(norm, config)
    row = norm.agg(*exprs).collect()[0]
    columns = norm.columns
    non_null = {c: row[f"nn{i}"] for i, c in enumerate(columns)}
    return PrePass(
        rows_in=row["rows_in"],
        non_null=non_null,
        lost={c: row[f"lost{i}"] for i, c in enumerate(casts)},
        score_zeros=row["zeros"],
        digit_only={c: row[f"digits{i}"] for i, c in enumerate(text)},
        # a declared key is never dropped: an all-empty key column must still quarantine its rows
        empty_columns=[c for c in columns if non_null[c] == 0 and c != config.key],
        columns=list(columns),
    )


def clean(df: DataFrame, config: QualityConfig = LISTINGS) -> CleanResult:
    """Normalise, type, repair, deduplicate and attach quarantine reasons."""
    norm = normalize(df)
    if not norm.columns:
        raise ValueError("table has no column")
    prepass = run_prepass(norm, config)
    kept = norm.drop(*prepass.empty_columns) if prepass.empty_columns else norm
    typed = typed_projection(kept, config, repair=True)
    if config.key and config.key in typed.columns:
        typed = dedup_by_key(typed, config.key)
    reasoned = typed.withColumn(REASONS, reasons_column(row_rules(config, typed.columns)))
    return CleanResult(reasoned, prepass, config)
