"""Normalisation, safe typing and value repair (projections only).

All functions return a DataFrame built from one ``select``: Catalyst collapses
it into a single Project inside the scan's whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tq.config import QualityConfig
from tq.functions.columns import (
    col,
    digit_only,
    normalize_text,
    null_if_equal,
    parse_flag,
    safe_cast,
    strip_currency,
)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def normalize(df: DataFrame) -> DataFrame:
    """Trim every text column and turn blanks into NULL; other columns pass through."""
    text = set(string_columns(df))
    return df.select([normalize_text(c).alias(c) if c in text else col(c) for c in df.columns])


def cast_plan(config: QualityConfig, columns) -> dict[str, str]:
    """Target type per column, in application order (key, currency, numeric, dates, scores)."""
    present = list(columns)
    names = set(present)
    plan: dict[str, str] = {}
    if config.key and config.key in names:
        plan[config.key] = "bigint"
    for c in config.currency:
        if c in names:
            plan[c] = "double"
    for c in config.numeric:
        if c in names:
            plan[c] = "double"
    for c in config.dates:
        if c in names:
            plan[c] = "date"
    for c in config.score_columns(present):
        plan[c] = "double"
    return plan


def typed_value(name: str, target: str, config: QualityConfig):
    """Safe cast of a normalised text column (currency symbols stripped first)."""
    source = strip_currency(name) if name in config.currency else col(name)
    return safe_cast(source, target)


def typed_projection(df: DataFrame, config: QualityConfig, repair: bool = True) -> DataFrame:
    """Normalised text -> typed (and, with ``repair``, repaired and flagged) columns.

    ``repair=False`` is the minimal typing used for the "before" validation:
    casts only, no flag parsing, no sentinel or digit-only removal, no added
    columns.
    """
    columns = df.columns
    casts = cast_plan(config, columns)
    scores = set(config.score_columns(columns)) if repair else set()
    flags = set(config.flags) if repair else set()
    scrub = set(config.digit_only_text) if repair else set()
    out = []
    for c in columns:
        if c in casts:
            v = typed_value(c, casts[c], config)
            if c in scores and config.score_zero_is_missing:
                v = null_if_equal(v, 0.0)
        elif c in flags:
            v = parse_flag(c, config.true_text, config.false_text)
        elif c in scrub:
            v = F.when(digit_only(c, config.digit_only_pattern), F.lit(None).cast(StringType())).otherwise(col(c))
        else:
            v = col(c)
        out.append(v.alias(c))
    if repair:
        if config.price and config.price in casts:
            out.append(typed_value(config.price, casts[config.price], config).isNull().alias(config.missing_flag))
        if config.long_stay and config.long_stay[0] in columns:
            name, limit = config.long_stay
            source = typed_value(name, casts[name], config) if name in casts else col(name)
            out.append((source > F.lit(float(limit))).alias(config.long_stay_flag))
    return df.select(out)


def minimal_typing(df: DataFrame, config: QualityConfig) -> DataFrame:
    """Normalise then safe-cast: the weaker typing of the "before" table (no value repaired)."""
    return typed_projection(normalize(df), config, repair=False)
