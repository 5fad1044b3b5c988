"""Row rules: each rule names a reason and a predicate on the typed row.

A rule emits its reason only when the predicate is TRUE; NULL and FALSE emit
nothing, so a missing value never quarantines a row by itself (except where a
rule says so, e.g. an invalid key).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tq.config import QualityConfig
from tq.functions.columns import col

REASONS = "reject_reasons"   # array<string>, rule order, empty = clean
REASON_TEXT = "reject_reason"  # comma-joined text, '' = clean


@dataclass(frozen=True)
class RowRule:
    reason: str
    requires: frozenset[str]
    predicate: Callable[[], Column]

    def applies_to(self, columns) -> bool:
        return self.requires <= set(columns)


def row_rules(config: QualityConfig, columns) -> list[RowRule]:
    """Rules of ``config`` whose columns all exist, in fixed order."""
    columns = list(columns)
    rules: list[RowRule] = []

    def add(reason, needs, predicate):
        rule = RowRule(reason, frozenset(needs), predicate)
        if rule.applies_to(columns):
            rules.append(rule)

    if config.key:
        k = config.key
        add("id_null_or_invalid" if k == "id" else f"{k}_null_or_invalid", [k], lambda: col(k).isNull())
    if config.price:
        p = config.price
        add(f"{p}_not_positive", [p], lambda: col(p) <= F.lit(0.0))
        if config.max_price is not None:
            add(f"{p}_too_high", [p], lambda: col(p) > F.lit(float(config.max_price)))
    for limit in config.limits:
        add(limit.reason, [limit.column], lambda lim=limit: col(lim.column) > F.lit(float(lim.high)))
    low, high = config.score_range
    for c in config.score_columns(columns):
        add(f"{c}_out_of_range", [c],
            lambda c=c: (col(c) < F.lit(float(low))) | (col(c) > F.lit(float(high))))
    if config.date_order:
        a, b = config.date_order
        add(f"{a}_after_{b}", [a, b], lambda: col(a) > col(b))
    if config.box:
        def outside():
            inside = None
            for bound in config.box:
                cond = col(bound.column).between(F.lit(float(bound.low)), F.lit(float(bound.high)))
                inside = cond if inside is None else inside & cond
            return ~inside
        add(config.box_reason, [b.column for b in config.box], outside)
    for relation in config.relations:
        add(relation.reason, relation.columns, lambda r=relation: F.expr(r.condition))
    return rules


def reasons_column(rules: list[RowRule]) -> Column:
    """``array<string>`` of violated rules, rule order kept, NULLs dropped."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(r.predicate(), F.lit(r.reason)) for r in rules]))


def with_reasons(df: DataFrame, config: QualityConfig) -> DataFrame:
    return df.withColumn(REASONS, reasons_column(row_rules(config, df.columns)))


def reason_text(c: Column | str = REASONS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c, ",")
