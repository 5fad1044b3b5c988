"""Declarative expectations, evaluated natively in Spark.

Cost of a suite: one aggregate for every row-level rule together (not-null,
between, pair order, regex, completeness) plus one grouped aggregate per
uniqueness rule (combined map-side, so a hot value does not overload one
task).  The one-row results are folded into one rule-per-row DataFrame
without joins.

Semantics per expectation (``unexpected`` / ``denominator``):

* not null: ``c IS NULL`` / all rows;
* unique: rows of non-null values occurring more than once / non-null rows;
* between: non-null values outside the interval / non-null rows;
* pair order (A >= B): ``NOT (A >= B)`` — a single NULL side is not counted —
  / rows where not both are NULL;
* not match regex: non-null values matching / non-null rows.

``success``: with ``mostly``: denominator 0, or ``1 - unexpected /
denominator >= mostly``; otherwise ``unexpected == 0``.
``unexpected_percent`` is rounded to 3 decimals, NULL when the denominator is 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tq.config import LISTING_COMPLETENESS, QualityConfig
from tq.functions.columns import col, count_if, pct
from tq.functions.frames import side_by_side
from tq.session import materialize

RESULT_COLUMNS = ["ordinal", "rule", "expectation", "column", "success", "unexpected_count",
                  "unexpected_percent", "checked_rows"]


@dataclass(frozen=True)
class Expectation:
    column: str
    mostly: float | None = None

    kind = "expectation"
    grouped = False

    @property
    def requires(self) -> frozenset[str]:
        return frozenset([self.column])

    def denominator(self) -> Column:
        return col(self.column).isNotNull()


@dataclass(frozen=True)
class NotNull(Expectation):
    kind = "not_null"

    def unexpected(self) -> Column:
        return col(self.column).isNull()

    def denominator(self) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class Unique(Expectation):
    kind = "unique"
    grouped = True

    def grouped_counts(self, df: DataFrame) -> DataFrame:
        """One row ``(u, d)``: rows in repeated values, non-null rows.

        Texts are counted by a 128-bit digest first; only those whose digest repeats are grouped themselves.
        """
        values = df.select(col(self.column).alias("v")).filter(F.col("v").isNotNull())
        repeated = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("u")
        total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("d")
        if not isinstance(values.schema["v"].dataType, StringType):
            return values.groupBy("v").agg(F.count(F.lit(1)).alias("n")).agg(repeated, total)
        digest = values.select("v", F.xxhash64(F.lit(1), "v").alias("a"), F.xxhash64(F.lit(2), "v").alias("b"))
        per_digest = digest.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
        again = digest.join(per_digest.filter(F.col("n") > 1).select("a", "b"), ["a", "b"], "left_semi")
        return side_by_side(again.groupBy("v").agg(F.count(F.lit(1)).alias("n")).agg(repeated), per_digest.agg(total))


@dataclass(frozen=True)
class Between(Expectation):
    low: float | None = None
    high: float | None = None
    strict_low: bool = False
    strict_high: bool = False
    kind = "between"

    def unexpected(self) -> Column:
        c = col(self.column)
        conds = []
        if self.low is not None:
            conds.append(c > F.lit(float(self.low)) if self.strict_low else c >= F.lit(float(self.low)))
        if self.high is not None:
            conds.append(c < F.lit(float(self.high)) if self.strict_high else c <= F.lit(float(self.high)))
        ok = reduce(lambda a, b: a & b, conds) if conds else F.lit(True)
        return c.isNotNull() & ~ok


@dataclass(frozen=True)
class PairOrder(Expectation):
    """``column`` (A) >= ``other`` (B), or > without ``or_equal``."""

    other: str = ""
    or_equal: bool = True
    kind = "pair_order"

    @property
    def requires(self) -> frozenset[str]:
        return frozenset([self.column, self.other])

    def unexpected(self) -> Column:
        a, b = col(self.column), col(self.other)
        return ~(a >= b) if self.or_equal else ~(a > b)

    def denominator(self) -> Column:
        return ~(col(self.column).isNull() & col(self.other).isNull())


@dataclass(frozen=True)
class NotMatchRegex(Expectation):
    regex: str = ""
    kind = "not_match_regex"

    def unexpected(self) -> Column:
        return col(self.column).rlike(self.regex)


Rule = tuple[str, Expectation]


def _num(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def build_rules(columns, config: QualityConfig, completeness: float | None = LISTING_COMPLETENESS) -> list[Rule]:
    """Labelled rules of ``config`` whose columns all exist, in fixed order."""
    names = set(columns)
    rules: list[Rule] = []

    def add(label: str, e: Expectation):
        if e.requires <= names:
            rules.append((label, e))

    if config.key:
        add(f"{config.key} not null", NotNull(config.key))
        add(f"{config.key} unique", Unique(config.key))
    if config.price:
        p = config.price
        add(f"{p} in ]0, {_num(config.max_price)}]" if config.max_price is not None else f"{p} > 0",
            Between(p, low=0, high=config.max_price, strict_low=True))
        if completeness is not None:
            add(f"{p} present in at least {_num(round(completeness * 100, 6))} % of rows",
                NotNull(p, mostly=completeness))
    for limit in config.limits:
        add(f"{limit.column} in [0, {_num(limit.high)}]", Between(limit.column, low=0, high=limit.high))
    low, high = config.score_range
    for c in sorted(config.score_columns(names)):
        add(f"{c} in ]{_num(low)}, {_num(high)}]", Between(c, low=low, high=high, strict_low=True))
    if config.date_order:
        a, b = config.date_order
        add(f"{b} >= {a}", PairOrder(b, other=a, or_equal=True))
    for bound in config.box:
        add(f"{bound.column} inside the box", Between(bound.column, low=bound.low, high=bound.high))
    for c in config.digit_only_text:
        add(f"{c} not only digits", NotMatchRegex(c, regex=config.digit_only_pattern))
    return rules


def _counts(df: DataFrame, rules: list[Rule], presence: bool = False) -> DataFrame:
    """One wide row: ``rows``, ``u<i>`` / ``d<i>`` per rule (and ``nn<j>`` per column)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, (_, e) in enumerate(rules):
        if not e.grouped:
            aggs += [count_if(e.unexpected()).alias(f"u{i}"), count_if(e.denominator()).alias(f"d{i}")]
    if presence:
        aggs += [F.count(col(c)).alias(f"nn{j}") for j, c in enumerate(df.columns)]
    frames = [df.agg(*aggs)]
    for i, (_, e) in enumerate(rules):
        if e.grouped:
            frames.append(e.grouped_counts(df).select(F.col("u").alias(f"u{i}"), F.col("d").alias(f"d{i}")))
    return side_by_side(*frames) if len(frames) > 1 else frames[0]


def _results(wide: DataFrame, rules: list[Rule]) -> DataFrame:
    if not rules:
        spark = wide.sparkSession
        return spark.createDataFrame([], "ordinal int, rule string, expectation string, column string, "
                                         "success boolean, unexpected_count bigint, unexpected_percent double, "
                                         "checked_rows bigint")
    structs = [F.struct(F.lit(i).alias("ordinal"), F.lit(label).alias("rule"), F.lit(e.kind).alias("expectation"),
                        F.lit(e.column).alias("column"),
                        F.lit(e.mostly).cast("double").alias("mostly"),
                        F.col(f"u{i}").cast("bigint").alias("u"), F.col(f"d{i}").cast("bigint").alias("d"),
                        F.col("rows").cast("bigint").alias("checked_rows"))
               for i, (label, e) in enumerate(rules)]
    rows = wide.select(F.inline(F.array(*structs)))
    ratio_ok = (F.lit(1.0) - F.col("u") / F.col("d")) >= F.col("mostly")
    success = F.when(F.col("mostly").isNull(), F.col("u") == 0) \
        .otherwise((F.col("d") == 0) | F.coalesce(ratio_ok, F.lit(False)))
    return rows.select("ordinal", "rule", "expectation", "column", success.alias("success"),
                       F.col("u").alias("unexpected_count"), pct(F.col("u"), F.col("d"), 3).alias("unexpected_percent"),
                       "checked_rows")


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: ``ordinal, rule, expectation, column, success, unexpected_count,
    unexpected_percent, checked_rows``."""
    return _results(_counts(df, rules), rules)


def status_text(success: Column, count: Column, percent: Column) -> Column:
    """``PASS`` / ``FAIL``, followed by ``(n rows, p %)`` when some rows are unexpected."""
    status = F.when(success, F.lit("PASS")).otherwise(F.lit("FAIL"))
    detail = F.concat(status, F.lit(" ("), count.cast("string"), F.lit(" rows, "),
                      F.coalesce(percent.cast("string"), F.lit("n/a")), F.lit(" %)"))
    return F.when(F.coalesce(count, F.lit(0)) > 0, detail).otherwise(status)


@dataclass
class Validation:
    """Before/after evaluation of one rule list; each side's counts are one cached one-row aggregate."""

    rules: list
    before_counts: DataFrame
    after_counts: DataFrame
    before_columns: int
    after_columns: int

    def side(self, which: str) -> DataFrame:
        """Per-rule results of one side (built once, reused by ``comparison`` and ``summary``)."""
        cache = self.__dict__.setdefault("_sides", {})
        if which not in cache:
            counts = self.before_counts if which == "before" else self.after_counts
            cache[which] = _results(counts, self.rules)
        return cache[which]

    def comparison(self) -> DataFrame:
        sides = [self.side("before").withColumn("side", F.lit("before")),
                 self.side("after").withColumn("side", F.lit("after"))]
        both = sides[0].unionByName(sides[1])
        pick = []
        for s in ("before", "after"):
            for c in ("success", "unexpected_count", "unexpected_percent", "checked_rows"):
                pick.append(F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c}"))
        out = both.groupBy("ordinal", "rule", "expectation", "column").agg(*pick)
        return out.withColumn("before_status", status_text(F.col("before_success"), F.col("before_unexpected_count"),
                                                           F.col("before_unexpected_percent"))) \
                  .withColumn("after_status", status_text(F.col("after_success"), F.col("after_unexpected_count"),
                                                          F.col("after_unexpected_percent")))

    def summary(self) -> DataFrame:
        parts = []
        for which, counts, ncols in (("before", self.before_counts, self.before_columns),
                                     ("after", self.after_counts, self.after_columns)):
            empty = reduce(lambda a, b: a + b, [F.when(F.col(f"nn{j}") == 0, 1).otherwise(0) for j in range(ncols)],
                           F.lit(0))
            passed = self.side(which).agg(count_if(F.col("success")).alias("rules_passed"))
            base = counts.select(F.col("rows").cast("bigint").alias("rows"), F.lit(ncols).alias("columns"),
                                 empty.cast("int").alias("fully_empty_columns"))
            out = side_by_side(base, passed).withColumn("rules_total", F.lit(len(self.rules)))
            parts.append(out.select(F.lit(which).alias("side"), *out.columns))
        return parts[0].unionByName(parts[1])

    def release(self) -> None:
        self.before_counts.unpersist()
        self.after_counts.unpersist()


def validate(before: DataFrame, after: DataFrame, config: QualityConfig,
             completeness: float | None = LISTING_COMPLETENESS, cache: bool = True) -> Validation:
    """Rules on the columns both tables have; one scan (plus one per uniqueness rule) per side.

    With ``cache``, each side's one-row counts are kept for several reports; call ``release()`` after the last.
    """
    common = [c for c in before.columns if c in set(after.columns)]
    rules = build_rules(common, config, completeness)
    b, a = _counts(before, rules, presence=True), _counts(after, rules, presence=True)
    if cache:
        b, a = b.cache(), a.cache()
    return Validation(rules, b, a, len(before.columns), len(after.columns))


def compare(before: DataFrame, after: DataFrame, config: QualityConfig,
            completeness: float | None = LISTING_COMPLETENESS) -> DataFrame:
    """The same rules (on the columns both tables have) evaluated on two tables, side by side."""
    return validate(before, after, config, completeness, cache=False).comparison()


def compare_summary(before: DataFrame, after: DataFrame, config: QualityConfig,
                    completeness: float | None = LISTING_COMPLETENESS) -> DataFrame:
    checked = validate(before, after, config, completeness)
    out = materialize(checked.summary())   # two rows; the cached counts can go then
    checked.release()
    return out


def unexpected_rows(df: DataFrame, expectation: Expectation) -> DataFrame:
    """The offending rows of one expectation.

    Row-level rules are a filter.  For uniqueness, the repeated values are
    found by a grouped count (combined map-side) and the rows are kept by a
    semi join on them — not by a window over each value, which would put every
    row of a hot value into one task.  The semi join runs under AQE's skew
    handling when one value holds a large share of the rows.
    """
    if isinstance(expectation, Unique):
        c = expectation.column
        repeated = (df.filter(col(c).isNotNull()).groupBy(col(c).alias("__v"))
                    .agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).select("__v"))
        return df.join(repeated, col(c) == F.col("__v"), "left_semi")
    return df.filter(expectation.unexpected() & expectation.denominator())
