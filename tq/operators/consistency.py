"""Rules that fixed limits cannot give: values against their group, rows against their neighbours.

``clean`` applies the rules that look at one row alone (``QualityConfig.relations``
among them).  Two further kinds need other rows and come after it:

* ``ratios``: bounds per group, median -/+ so many median absolute deviations of the
  trusted rows, learned once (``learn``) and kept as a table, so that later
  tables are judged by the same bounds;
* ``nearby``: rows whose coordinates have too few others around them, among the rows
  that no other rule rejects.

``judged`` appends their reasons to the rows of a ``CleanResult``. A missing value, a
group without bounds and a row without coordinates give no reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tq.config import QualityConfig, Ratio
from tq.functions.columns import col, count_if
from tq.functions.frames import bounded_broadcast
from tq.operators.clean import QUARANTINED, CleanResult
from tq.operators.detect import injected_rows
from tq.operators.inject import ERROR_TYPE, ErrorType
from tq.operators.nearby import isolated_places
from tq.operators.rules import REASONS
from tq.operators.spread import Scratch, bounds, group_spread, outside_bounds


@dataclass
class Learned:
    """Bounds per group of each ratio, as written tables; ``release()`` deletes them."""

    config: QualityConfig
    limits: list[tuple[Ratio, DataFrame, int]]
    scratch: Scratch

    def release(self) -> None:
        self.scratch.release()


def ratio_value(ratio: Ratio) -> Column:
    """The ratio of a typed row; NULL where the denominator is 0."""
    top = col(ratio.numerator)
    return top if ratio.denominator is None else top / F.nullif(col(ratio.denominator), F.lit(0.0))


def learn(rows: DataFrame, config: QualityConfig) -> Learned:
    """Bounds of the ratios whose columns exist, from trusted typed rows."""
    scratch = Scratch(rows.sparkSession, "consistency")
    limits = []
    for ratio in config.ratios:
        if set(ratio.columns) <= set(rows.columns):
            kept = scratch.write(bounds(group_spread(rows, ratio.by, ratio_value(ratio), scratch), ratio.cutoff, ratio.least))
            limits.append((ratio, kept, kept.count()))
    return Learned(config, limits, scratch)


def judged(result: CleanResult, learned: Learned) -> CleanResult:
    """``result`` with the reasons of the ratios and of the neighbours appended to those of its rows."""
    config = learned.config
    columns = [c for c in result.reasoned.columns if c != QUARANTINED]
    rows = result.reasoned.select(*[col(c) for c in columns])
    flags = []
    for i, (ratio, limits, groups) in enumerate(learned.limits):
        flags.append((f"__r{i}", ratio.reason))
        rows = outside_bounds(rows, limits, ratio.by, ratio_value(ratio), f"__r{i}", groups)
    if config.nearby and {config.nearby.x, config.nearby.y} <= set(columns):
        n = config.nearby
        sound = rows.filter(F.size(REASONS) == 0)
        for flag, _ in flags:
            sound = sound.filter(~F.col(flag))
        lonely = learned.scratch.write(isolated_places(sound, col(n.x), col(n.y), n.radius, n.least).select("x", "y"))
        lonely = bounded_broadcast(lonely.select(F.col("x").alias("__x"), F.col("y").alias("__y"), F.lit(True).alias("__lonely")), lonely.count())
        place = (col(n.x) + F.lit(0.0) == F.col("__x")) & (col(n.y) + F.lit(0.0) == F.col("__y"))
        rows = rows.join(lonely, place, "left").drop("__x", "__y")
        flags.append(("__lonely", n.reason))
    if not flags:
        return CleanResult(rows, result.prepass, config)
    more = F.array_compact(F.array(*[F.when(F.col(flag), F.lit(reason)) for flag, reason in flags]))
    rows = rows.withColumn(REASONS, F.concat(REASONS, more)).select(*[col(c) for c in columns])
    return CleanResult(rows, result.prepass, config)


def accepted_reasons(types: list[ErrorType], config: QualityConfig) -> dict[str, list[str]]:
    """For each error type that leaves a reason: its own reason, and those of the rules over the columns it edits."""
    out = {}
    for t in types:
        if t.trace[0] == "reason":
            edited = set(t.edits)
            more = [r.reason for r in config.relations if edited & set(r.columns)]
            more += [r.reason for r in config.ratios if edited & {r.numerator, r.denominator}]
            more += [config.nearby.reason] if config.nearby and edited & {config.nearby.x, config.nearby.y} else []
            out[t.name] = [t.trace[1], *more]
    return out


def recall_with(after: CleanResult, assignments: DataFrame, types: list[ErrorType], config: QualityConfig, max_assigned: int) -> DataFrame:
    """Per error type that leaves a reason: ``error_type, injected, detected_fixed, detected, recall_fixed_pct, recall_pct``:
    caught by its fixed rule, and by that or a rule that compares columns, groups or neighbours."""
    accepted = accepted_reasons(types, config)
    if not accepted:
        return assignments.sparkSession.createDataFrame(
            [], "error_type string, injected bigint, detected_fixed bigint, detected bigint, recall_fixed_pct double, recall_pct double")
    named = F.create_map(*[x for name, reasons in accepted.items() for x in (F.lit(name), F.array(*[F.lit(r) for r in reasons]))])
    found = injected_rows(after, assignments, config.key, max_assigned).filter(F.col(ERROR_TYPE).isin(*accepted))
    wanted = F.element_at(named, F.col(ERROR_TYPE))
    counts = found.withColumn("wanted", wanted).groupBy(ERROR_TYPE).agg(
        F.count(F.lit(1)).alias("injected"),
        count_if(F.array_contains("__r", F.element_at("wanted", 1))).alias("detected_fixed"),
        count_if(F.arrays_overlap("__r", "wanted")).alias("detected"))
    pct = lambda c: F.round(F.lit(100.0) * F.col(c) / F.col("injected"), 1)
    return counts.withColumn("recall_fixed_pct", pct("detected_fixed")).withColumn("recall_pct", pct("detected"))
