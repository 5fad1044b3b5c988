"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given tables (or ``dirty``, which Spark derives from
them), so its work grows with the scale factor.  The listing preset is used
for ``dirty``; the key is ``id``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tq.config import CONSISTENT_LISTINGS, LISTINGS, InjectionConfig, Limit, QualityConfig
from tq.functions.columns import col, count_if, is_blank, null_if_match, parse_currency, parse_flag, safe_cast
from tq.functions.frames import bounded_broadcast, side_by_side
from tq.operators import explore as X
from tq.operators import consistency
from tq.operators.clean import clean
from tq.operators.dedup import dedup_by_key
from tq.operators.expect import (
    Between,
    NotMatchRegex,
    NotNull,
    PairOrder,
    Unique,
    build_rules,
    compare,
    compare_summary,
    evaluate,
    unexpected_rows,
)
from tq.operators.explore import PRICE_FORMAT, PRICE_PROBS
from tq.operators.inject import ERROR_TYPE, assign, corrupt, error_types, typed_key
from tq.operators.inject import seeded_sample as _seeded_sample
from tq.operators.nearby import local_outliers
from tq.operators.normalize import cast_plan, minimal_typing, normalize, typed_projection
from tq.operators.profile import column_presence, duplicate_keys, duplicate_rows, profile, table_summary
from tq.operators.quantiles import approx_quantiles, exact_quantiles
from tq.operators.spread import group_outliers
from tq.operators.spread import group_spread as _group_spread
from tq.operators.rules import REASON_TEXT, REASONS, reason_text
from tq.operators.state import add_slice, drift, merged_profile
from tq.plans.experiment import run_consistency_experiment, run_experiment
from tq.plans.steps import run as run_steps
from tq.session import materialize
from tq.sources.files import fresh_scratch, read_partitioned, read_raw_csv, write_json, write_profile_csv, write_raw_csv
from tq.sources.files import stage_new, stage_raw as _stage_raw
from tq.sources.tables import dirty, read_table
from tq.streaming.dedup import start_dedup_stream, survivors
from tq.streaming.quarantine import reasoned_stream, start_quarantine_stream
from tq.streaming.validation import running_result, start_validation_stream

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(fn: Query) -> Query:
    CATALOG[fn.__name__] = fn
    return fn


def _clean(spark, sf_dir):
    return clean(dirty(spark, sf_dir), LISTINGS)


def _typed(spark, sf_dir):
    """Typed and repaired dirty rows, empty columns dropped, before dedup."""
    norm = normalize(dirty(spark, sf_dir))
    return typed_projection(_drop_empty(norm), LISTINGS, repair=True)


def _staged(spark, df: DataFrame) -> DataFrame:
    """``df`` written once: its columns are not computed again wherever they are named, nor in every pass."""
    path = fresh_scratch(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop_empty(norm: DataFrame) -> DataFrame:
    from tq.operators.profile import empty_column_names

    empty = [c for c in empty_column_names(norm) if c != LISTINGS.key]
    return norm.drop(*empty) if empty else norm


# --- clean + quarantine (N, R, Q, U) -------------------------------------------------------------

@query
def quarantine_reason_counts(spark, sf_dir):
    return _clean(spark, sf_dir).reason_counts()


@query
def quarantine_clean_rows(spark, sf_dir):
    return _clean(spark, sf_dir).clean


@query
def quarantine_rejected_rows(spark, sf_dir):
    return _clean(spark, sf_dir).rejected


@query
def row_rules_reasons(spark, sf_dir):
    r = _clean(spark, sf_dir).reasoned
    return r.withColumn(REASON_TEXT, reason_text(REASONS)).drop(REASONS)


@query
def clean_metrics(spark, sf_dir):
    return _clean(spark, sf_dir).metrics()


@query
def row_reconciliation(spark, sf_dir):
    """rows_clean + rows_quarantined = rows_in - duplicates, with duplicates counted independently."""
    result = _clean(spark, sf_dir)
    sizes = result.reasoned.agg(
        count_if(F.size(REASONS) == 0).alias("rows_clean"),
        count_if(F.size(REASONS) > 0).alias("rows_quarantined"),
    )
    # one pass over the raw keys: group sizes give the rows and, for valid keys, the duplicates
    per_key = dirty(spark, sf_dir).groupBy(typed_key("id").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_in"),
                         F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n") - 1)), F.lit(0))
                         .cast("bigint").alias("duplicates"))
    out = side_by_side(totals, sizes)
    return out.withColumn("balanced", (F.col("rows_clean") + F.col("rows_quarantined"))
                          == (F.col("rows_in") - F.col("duplicates")))


@query
def dedup_by_key_rows(spark, sf_dir):
    return dedup_by_key(_typed(spark, sf_dir), "id")


@query
def normalize_text_rows(spark, sf_dir):
    return normalize(dirty(spark, sf_dir))


@query
def blank_predicate(spark, sf_dir):
    d = dirty(spark, sf_dir)
    return d.select(col("id").alias("raw_id"), *[is_blank(c).alias(f"{c}_blank") for c in d.columns])


@query
def safe_cast_rows(spark, sf_dir):
    n = normalize(dirty(spark, sf_dir))
    return n.select(col("id").alias("raw_id"),
                    safe_cast("id", "bigint").alias("id"),
                    safe_cast("beds", "double").alias("beds"),
                    safe_cast("first_review", "date").alias("first_review"),
                    safe_cast("latitude", "double").alias("latitude"),
                    safe_cast("price", "double").alias("price_without_strip"))


@query
def parse_currency_rows(spark, sf_dir):
    n = normalize(dirty(spark, sf_dir))
    return n.select(col("price").alias("price_text"), parse_currency("price").alias("price"))


@query
def parse_flag_rows(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    status = F.lower(F.col("o_orderstatus"))
    return o.select("o_orderkey", status.alias("status_text"), parse_flag(status).alias("status_flag"))


@query
def missing_indicator(spark, sf_dir):
    return _typed(spark, sf_dir).select("id", "price", "price_missing")


@query
def sentinel_to_null(spark, sf_dir):
    n = normalize(dirty(spark, sf_dir))
    t = _typed(spark, sf_dir)
    zeros = n.agg(count_if(safe_cast("review_scores_rating", "double") == 0).alias("zeros_set_to_null"))
    nulls = t.agg(count_if(F.col("review_scores_rating").isNull()).alias("null_scores"),
                  F.count("review_scores_rating").alias("scores"))
    return side_by_side(zeros, nulls)


@query
def scrub_numeric_text(spark, sf_dir):
    n = normalize(dirty(spark, sf_dir))
    return n.select(col("id").alias("raw_id"), col("host_about").alias("host_about_text"),
                    null_if_match("host_about", LISTINGS.digit_only_pattern).alias("host_about"))


@query
def threshold_flag(spark, sf_dir):
    return _typed(spark, sf_dir).select("id", "minimum_nights", "flag_minimum_nights_gt_365")


@query
def conversion_loss(spark, sf_dir):
    n = normalize(dirty(spark, sf_dir))
    plan = cast_plan(LISTINGS, n.columns)
    exprs = [count_if(col(c).isNotNull() & (parse_currency(c) if c in LISTINGS.currency
                                           else safe_cast(c, t)).isNull()).alias(c) for c, t in plan.items()]
    wide = n.agg(*exprs)
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("lost"))
                                          for c in plan])))


@query
def minimal_typing_rows(spark, sf_dir):
    return minimal_typing(dirty(spark, sf_dir), LISTINGS)


@query
def drop_empty_columns(spark, sf_dir):
    return column_presence(normalize(dirty(spark, sf_dir))).filter(F.col("non_null") == 0) \
        .select("column", "ordinal")


# --- profile (A1-A8) ------------------------------------------------------------------------------


@query
def profile_table(spark, sf_dir):
    return table_summary(dirty(spark, sf_dir), key="id")


@query
def profile_columns(spark, sf_dir):
    return profile(dirty(spark, sf_dir), approx=False)


@query
def profile_approx_distinct(spark, sf_dir):
    """HyperLogLog++ counts (the default path), judged against exact ones: within three standard deviations (rsd 5 %)."""
    d = dirty(spark, sf_dir)
    both = profile(d, approx=True, exact_distinct=True)
    error = F.abs(F.col("distinct_approx") - F.col("distinct_exact"))
    return both.select("column", "distinct_exact", (error <= 3 * 0.05 * F.col("distinct_exact")).alias("within_error"))


@query
def profile_exact_distinct(spark, sf_dir):
    return profile(dirty(spark, sf_dir), approx=False, exact_distinct=True).select("column", "distinct_exact")


@query
def profile_lineitem_columns(spark, sf_dir):
    return profile(read_table(spark, sf_dir, "lineitem"), approx=False, exact_distinct=True)


@query
def profile_documents_columns(spark, sf_dir):
    return profile(read_table(spark, sf_dir, "documents"), approx=False)


@query
def profile_events_columns(spark, sf_dir):
    return profile(read_table(spark, sf_dir, "events"), approx=False, exact_distinct=True)


@query
def profile_conversations_columns(spark, sf_dir):
    return profile(read_table(spark, sf_dir, "conversations"), approx=False)


@query
def profile_pages_columns(spark, sf_dir):
    return profile(read_table(spark, sf_dir, "pages"), approx=False)


@query
def profile_embeddings_columns(spark, sf_dir):
    """Every column has a row, the array column too (missing and distinct values, no range)."""
    return profile(read_table(spark, sf_dir, "embeddings"), approx=False, exact_distinct=True)


@query
def duplicate_rows_count(spark, sf_dir):
    """Whole-row duplicates: the dirty rows, and those whose id ends in 7 once more."""
    d = dirty(spark, sf_dir)
    return duplicate_rows(d.unionByName(d.filter(col("id").endswith("7"))))


@query
def duplicate_keys_count(spark, sf_dir):
    return duplicate_keys(dirty(spark, sf_dir), "id")


@query
def empty_columns(spark, sf_dir):
    return column_presence(normalize(dirty(spark, sf_dir))).withColumn("empty", F.col("non_null") == 0)


# --- exploration (E1-E10) -------------------------------------------------------------------------

@query
def explore_format_check(spark, sf_dir):
    return X.format_check(dirty(spark, sf_dir), "price", PRICE_FORMAT)


@query
def explore_non_positive(spark, sf_dir):
    return X.non_positive(dirty(spark, sf_dir), "price")


@query
def explore_quantiles(spark, sf_dir):
    """Exact quantiles of a column that holds infinite values: prices, with ``n/a`` as infinity."""
    price = F.when(col("price") == "n/a", F.lit(float("inf"))).otherwise(parse_currency("price"))
    return exact_quantiles(dirty(spark, sf_dir).select(price.alias("price_num")), "price_num", PRICE_PROBS)


@query
def explore_quantiles_approx(spark, sf_dir):
    """Approximate quantiles (the default path), judged by rank: within ``relative_error * n`` of the wanted one."""
    error = 0.001
    d = dirty(spark, sf_dir).select(parse_currency("price").alias("price_num")).filter("price_num is not null")
    found = approx_quantiles(d, "price_num", PRICE_PROBS, relative_error=error)
    values = {r.probability: r.value for r in found.collect()}   # four numbers
    v = F.col("price_num")
    ranks = d.agg(F.count(F.lit(1)).alias("n"), *[c for i, x in enumerate(values.values()) for c in
                                                 (count_if(v < x).alias(f"below{i}"), count_if(v <= x).alias(f"upto{i}"))])
    slack = F.lit(error) * F.col("n") + 1
    items = [F.struct(F.lit(p).alias("probability"), F.col("n") * F.lit(p) + slack >= F.col(f"below{i}"),
                      F.col("n") * F.lit(p) - slack <= F.col(f"upto{i}")) for i, p in enumerate(values)]
    judged = ranks.select(F.inline(F.array(*items))).toDF("probability", "low", "high")
    return judged.select("probability", (F.col("low") & F.col("high")).alias("within_error"))


@query
def explore_top_values(spark, sf_dir):
    return X.top_values(dirty(spark, sf_dir), parse_currency("price"), "id", 5, "price_num")


@query
def explore_cross_missing(spark, sf_dir):
    return X.cross_missing(dirty(spark, sf_dir), "price", "review_scores_rating")


@query
def explore_extremes(spark, sf_dir):
    return X.extremes(dirty(spark, sf_dir), ["beds", "minimum_nights"], "id")


@query
def explore_score_ranges(spark, sf_dir):
    d = dirty(spark, sf_dir)
    return X.score_ranges(d, LISTINGS.score_columns(d.columns), *LISTINGS.score_range)


@query
def explore_date_order(spark, sf_dir):
    return X.date_order(dirty(spark, sf_dir), "first_review", "last_review")


@query
def explore_outside_box(spark, sf_dir):
    return X.outside_box(dirty(spark, sf_dir), LISTINGS.box)


@query
def explore_numeric_text(spark, sf_dir):
    return X.numeric_text(dirty(spark, sf_dir), "host_about", LISTINGS.digit_only_pattern)


# --- expectations (V1-V11) ------------------------------------------------------------------------



def _before(spark, sf_dir):
    return minimal_typing(dirty(spark, sf_dir), LISTINGS)


@query
def validate_suite(spark, sf_dir):
    after = _clean(spark, sf_dir).clean
    return evaluate(after, build_rules(after.columns, LISTINGS))


@query
def expect_not_null(spark, sf_dir):
    return evaluate(_before(spark, sf_dir), [("price not null", NotNull("price")),
                                              ("beds not null", NotNull("beds"))])


@query
def expect_unique(spark, sf_dir):
    return evaluate(_before(spark, sf_dir), [("id unique", Unique("id")), ("host_about unique", Unique("host_about"))])


@query
def expect_between(spark, sf_dir):
    return evaluate(_before(spark, sf_dir), [
        ("price in ]0, 10000]", Between("price", low=0, high=10000, strict_low=True)),
        ("beds in [0, 20]", Between("beds", low=0, high=20)),
        ("review_scores_rating in ]0, 5]", Between("review_scores_rating", low=0, high=5, strict_low=True)),
    ])


@query
def expect_pair_order(spark, sf_dir):
    return evaluate(_before(spark, sf_dir), [
        ("last_review >= first_review", PairOrder("last_review", other="first_review", or_equal=True)),
        ("last_review > first_review", PairOrder("last_review", other="first_review", or_equal=False)),
    ])


@query
def expect_not_match_regex(spark, sf_dir):
    return evaluate(_before(spark, sf_dir), [
        ("host_about not only digits", NotMatchRegex("host_about", regex=LISTINGS.digit_only_pattern))])


@query
def expect_mostly(spark, sf_dir):
    return evaluate(_before(spark, sf_dir), [
        ("price present in at least 95 % of rows", NotNull("price", mostly=0.95)),
        ("beds present in at least 80 % of rows", NotNull("beds", mostly=0.80)),
    ])


@query
def validate_customer(spark, sf_dir):
    """Expectations on a driver table as it is: key uniqueness and balance range."""
    customer = read_table(spark, sf_dir, "customer")
    return evaluate(customer, [
        ("c_custkey not null", NotNull("c_custkey")),
        ("c_custkey unique", Unique("c_custkey")),
        ("c_acctbal in [0, 10000]", Between("c_acctbal", low=0, high=10000)),
        ("c_name unique", Unique("c_name")),
    ])


@query
def validate_before_after(spark, sf_dir):
    return compare(_before(spark, sf_dir), _clean(spark, sf_dir).clean, LISTINGS) \
        .drop("before_status", "after_status")


@query
def validate_summary(spark, sf_dir):
    return compare_summary(_before(spark, sf_dir), _clean(spark, sf_dir).clean, LISTINGS)


@query
def validate_status_text(spark, sf_dir):
    return compare(_before(spark, sf_dir), _clean(spark, sf_dir).clean, LISTINGS) \
        .select("ordinal", "rule", "before_status", "after_status")


# --- error injection and detection (J, O2, I, D) --------------------------------------------------


# n and seed of the published experiment; md5 ordering keeps the result portable to the oracle
INJECTION = InjectionConfig(n=500, seed=42, hash="md5")


def _valid_keys(spark, sf_dir):
    return _clean(spark, sf_dir).clean.select("id")


def _assignments(spark, sf_dir):
    d = dirty(spark, sf_dir)
    return assign(d, _valid_keys(spark, sf_dir), LISTINGS, INJECTION)


def _corrupted(spark, sf_dir, assignments=None):
    d = dirty(spark, sf_dir)
    return corrupt(d, _assignments(spark, sf_dir) if assignments is None else assignments, LISTINGS, INJECTION)


@query
def valid_rows_semi_join(spark, sf_dir):
    d = dirty(spark, sf_dir)
    valid = _valid_keys(spark, sf_dir).select(F.col("id").alias("__k"))
    # the valid keys are hashed per partition: the rows are not sorted
    return d.withColumn("__k", typed_key("id")).join(valid.hint("shuffle_hash"), "__k", "left_semi").drop("__k")


@query
def unused_rows_anti_join(spark, sf_dir):
    """Valid raw rows whose key received no error."""
    valid = valid_rows_semi_join(spark, sf_dir)
    used = _assignments(spark, sf_dir).select(F.col("id").alias("__k"))
    used = bounded_broadcast(used, INJECTION.n * len(error_types(LISTINGS)))
    return valid.withColumn("__k", typed_key("id")).join(used, "__k", "left_anti").drop("__k")


@query
def seeded_sample(spark, sf_dir):
    return _seeded_sample(dirty(spark, sf_dir), "id", INJECTION.n, INJECTION.seed, "md5")


@query
def seeded_sample_xxhash(spark, sf_dir):
    """The default hash: how many keys it samples, whether they are distinct, the smallest by hash, and the same again."""
    d = dirty(spark, sf_dir)
    first = _seeded_sample(d, "id", INJECTION.n, INJECTION.seed)
    second = _seeded_sample(d, "id", INJECTION.n, INJECTION.seed)
    keys = d.select(typed_key("id").alias("id")).filter("id is not null").distinct()
    hashed = keys.withColumn("h", F.xxhash64(F.col("id").cast("string"), F.lit(INJECTION.seed)))
    edge = first.agg(F.max("h").alias("edge"))
    rest = hashed.join(bounded_broadcast(first.select("id"), INJECTION.n), "id", "left_anti").agg(F.min("h").alias("next"))
    sizes = first.agg(F.count(F.lit(1)).alias("sampled"), F.count_distinct("id").alias("different"))
    again = first.join(second, ["id", "key_text", "h"], "left_semi").agg(F.count(F.lit(1)).alias("same"))
    return side_by_side(sizes, edge, rest, again).select(
        "sampled", (F.col("different") == F.col("sampled")).alias("all_distinct"),
        F.coalesce(F.col("edge") < F.col("next"), F.lit(True)).alias("smallest"),
        (F.col("same") == F.col("sampled")).alias("repeatable"))


@query
def inject_assignments(spark, sf_dir):
    return _assignments(spark, sf_dir)


def _inject_type(name, columns):
    def q(spark, sf_dir):
        assignments = materialize(_assignments(spark, sf_dir))   # n rows per type, read twice
        picked = assignments.filter(F.col(ERROR_TYPE) == name).select(F.col("id").alias("__k"))
        rows = _corrupted(spark, sf_dir, assignments).withColumn("__k", typed_key("id"))
        return rows.join(bounded_broadcast(picked, INJECTION.n), "__k", "left_semi").select(F.col("__k").alias("key"), *columns)
    q.__name__ = f"inject_{name}"
    return q


for _t in error_types(LISTINGS):
    if _t.name != "duplicate_rows":
        query(_inject_type(_t.name, ["id", *_t.edits]))


@query
def inject_duplicate_rows(spark, sf_dir):
    assignments = materialize(_assignments(spark, sf_dir))   # n rows per type, read twice
    picked = assignments.filter(F.col(ERROR_TYPE) == "duplicate_rows").select(F.col("id").alias("key"))
    rows = _corrupted(spark, sf_dir, assignments).withColumn("key", typed_key("id"))
    return rows.join(bounded_broadcast(picked, INJECTION.n), "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("copies"))


@query
def inject_all(spark, sf_dir):
    return _corrupted(spark, sf_dir)


# the same table under other names: every error type takes its columns from the configuration
OTHER_NAMES = {"id": "listing_id", "price": "cost", "beds": "places", "review_scores_rating": "review_scores_total",
               "first_review": "opened", "last_review": "seen", "latitude": "north", "longitude": "east",
               "host_about": "about"}
OTHER = LISTINGS.with_(
    key="listing_id", currency=("cost",), price="cost", main_score="review_scores_total", date_order=("opened", "seen"),
    numeric=tuple(OTHER_NAMES.get(c, c) for c in LISTINGS.numeric), dates=("opened", "seen"), digit_only_text=("about",),
    limits=tuple(Limit(OTHER_NAMES.get(x.column, x.column), x.high) for x in LISTINGS.limits),
    box=tuple(replace(b, column=OTHER_NAMES[b.column]) for b in LISTINGS.box))


@query
def inject_other_key(spark, sf_dir):
    """All nine error types on a table whose key and columns have other names."""
    d = dirty(spark, sf_dir).withColumnsRenamed(OTHER_NAMES)
    valid = clean(d, OTHER).clean.select("listing_id")
    return corrupt(d, assign(d, valid, OTHER, INJECTION), OTHER, INJECTION)


def _measured(spark, sf_dir, what):
    """One result of the experiment; its tables are deleted again, the result is checkpointed."""
    e = run_experiment(dirty(spark, sf_dir), LISTINGS, INJECTION)
    out = materialize(what(e))
    e.release()
    return out


@query
def detection_recall(spark, sf_dir):
    return _measured(spark, sf_dir, lambda e: e.recall())


@query
def detection_overall(spark, sf_dir):
    return _measured(spark, sf_dir, lambda e: e.overall())


@query
def collateral_rows(spark, sf_dir):
    return _measured(spark, sf_dir, lambda e: e.collateral())


# --- sources and sinks (S1-S7) --------------------------------------------------------------------



def _dirty_with_note(spark, sf_dir):
    """dirty plus a free-text column holding doubled quotes and an embedded newline."""
    d = dirty(spark, sf_dir)
    note = F.concat(F.lit('He said "ok" for '), F.coalesce(F.col("id"), F.lit("none")), F.lit("\nsecond line"))
    return d.withColumn("note", note)


@query
def scan_csv_roundtrip(spark, sf_dir):
    path = fresh_scratch(spark, "raw-csv")
    write_raw_csv(_dirty_with_note(spark, sf_dir), path)
    return normalize(read_raw_csv(spark, path))


@query
def stage_raw(spark, sf_dir):
    csv_path = fresh_scratch(spark, "raw-csv")
    write_raw_csv(_dirty_with_note(spark, sf_dir), csv_path)
    staged = _stage_raw(spark, csv_path, fresh_scratch(spark, "raw-parquet"), partitions=4)
    return normalize(staged)


@query
def clean_output_parquet(spark, sf_dir):
    saved = _clean(spark, sf_dir).save(fresh_scratch(spark, "reasoned"))
    return saved.clean


@query
def quarantine_output_parquet(spark, sf_dir):
    saved = _clean(spark, sf_dir).save(fresh_scratch(spark, "reasoned"))
    return saved.rejected


@query
def clean_metrics_json(spark, sf_dir):
    path = fresh_scratch(spark, "metrics")
    write_json(_clean(spark, sf_dir).metrics(), path)
    return spark.read.schema("metric string, key string, value bigint").json(path)


@query
def profile_report_csv(spark, sf_dir):
    """The profile as CSV, read back in the order of its lines."""
    path = fresh_scratch(spark, "profile")
    write_profile_csv(profile(dirty(spark, sf_dir)), path)
    lines = spark.read.option("header", "true").csv(path).withColumn("place", F.monotonically_increasing_id())
    return lines.select("place", "column", F.col("missing_count").cast("bigint").alias("missing_count"))


@query
def validation_report_json(spark, sf_dir):
    path = fresh_scratch(spark, "validation")
    checked = compare(_before(spark, sf_dir), _clean(spark, sf_dir).clean, LISTINGS)
    write_json(checked, path)
    return spark.read.schema(checked.schema).json(path).select("ordinal", "rule", "before_status", "after_status")


@query
def recall_report_json(spark, sf_dir):
    e = run_experiment(dirty(spark, sf_dir), LISTINGS, INJECTION)
    paths = e.write_report(fresh_scratch(spark, "recall"))
    schema = e.recall().schema
    e.release()
    return spark.read.schema(schema).json(paths["recall"])


@query
def pipeline_run(spark, sf_dir):
    """From raw CSV to every output of the three steps, read back: the metrics, and the missing values per column."""
    csv_path = fresh_scratch(spark, "raw-csv")
    write_raw_csv(_dirty_with_note(spark, sf_dir), csv_path)
    raw = _stage_raw(spark, csv_path, fresh_scratch(spark, "raw-parquet"), partitions=4)
    out = run_steps(spark, raw, fresh_scratch(spark, "run"))
    metrics = spark.read.schema("metric string, key string, value bigint").json(out["metrics"])
    profiled = spark.read.option("header", "true").csv(out["profile"])
    missing = profiled.select(F.lit("missing").alias("metric"), F.col("column").alias("key"),
                              F.col("missing_count").cast("bigint").alias("value"))
    sides = spark.read.schema("side string, rules_passed bigint").json(out["validation_summary"])
    passed = sides.select(F.lit("rules_passed").alias("metric"), F.col("side").alias("key"), F.col("rules_passed").alias("value"))
    return metrics.unionByName(missing).unionByName(passed)


# --- offending rows of an expectation (W3) --------------------------------------------------------



@query
def expect_unique_rows(spark, sf_dir):
    return unexpected_rows(_before(spark, sf_dir), Unique("id"))


@query
def expect_between_rows(spark, sf_dir):
    return unexpected_rows(_before(spark, sf_dir), Between("price", low=0, high=10000, strict_low=True))


@query
def expect_pair_order_rows(spark, sf_dir):
    return unexpected_rows(_before(spark, sf_dir), PairOrder("last_review", other="first_review"))


# --- streaming row rules (stateless) --------------------------------------------------------------



@query
def stream_row_rules(spark, sf_dir):
    """dirty landed as Parquet files, read as a stream, reasoned per micro-batch, read back."""
    landing = fresh_scratch(spark, "landing")
    d = dirty(spark, sf_dir)
    d.write.parquet(landing)
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 4).parquet(landing)
    out, ckpt = fresh_scratch(spark, "stream-out"), fresh_scratch(spark, "stream-ckpt")
    q = start_quarantine_stream(stream, out, ckpt, LISTINGS, available_now=True)
    q.awaitTermination()
    return read_partitioned(spark, out, schema=reasoned_stream(d, LISTINGS).schema)


# --- the same rules, configured for a typed driver table ----------------------------------------


# line items must not ship before their order, quantities and discounts stay in range
LINE_ITEMS = QualityConfig(
    numeric=("l_quantity", "l_discount"),
    limits=(Limit("l_quantity", 50), Limit("l_discount", 0.1)),
    date_order=("o_orderdate", "l_shipdate"),
)


def _line_items(spark, sf_dir):
    """Line items with their order date; one without its order keeps its row and has no date."""
    items = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return items.join(orders, "l_orderkey", "left")


@query
def line_item_reason_counts(spark, sf_dir):
    return clean(_line_items(spark, sf_dir), LINE_ITEMS).reason_counts()


@query
def line_item_suite(spark, sf_dir):
    rows = _line_items(spark, sf_dir)
    return evaluate(rows, [
        ("l_quantity in [1, 50]", Between("l_quantity", low=1, high=50)),
        ("l_discount in [0, 0.1]", Between("l_discount", low=0, high=0.1)),
        ("l_shipdate >= o_orderdate", PairOrder("l_shipdate", other="o_orderdate")),
        ("l_returnflag not null", NotNull("l_returnflag")),
        ("the order exists", NotNull("o_orderdate")),
    ])


@query
def validate_documents(spark, sf_dir):
    """Expectations on the document table as it is (repeated texts are real defects)."""
    docs = read_table(spark, sf_dir, "documents")
    return evaluate(docs, [
        ("doc_id unique", Unique("doc_id")),
        ("text unique", Unique("text")),
        ("text not null", NotNull("text")),
        ("n_chars in [1, 20000]", Between("n_chars", low=1, high=20000)),
        ("lang is a two-letter code", NotMatchRegex("lang", regex=r"[^a-z]")),
    ])


@query
def validate_labels(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels")
    return evaluate(labels, [
        ("doc_id unique", Unique("doc_id")),
        ("quality in [0, 1]", Between("quality", low=0, high=1)),
        ("toxic in [0, 1]", Between("toxic", low=0, high=1)),
        ("quality present in at least 99 % of rows", NotNull("quality", mostly=0.99)),
    ])


# --- groups, neighbours and columns compared (X1, X2) ---------------------------------------------


@query
def group_spread(spark, sf_dir):
    """Count, median and median absolute deviation of the price by bedrooms (a missing number is a group too)."""
    return _group_spread(_before(spark, sf_dir), ["bedrooms"], "price")


@query
def group_spread_parts(spark, sf_dir):
    """The same for many groups: extended prices by part and return flag."""
    return _group_spread(read_table(spark, sf_dir, "lineitem"), ["l_partkey", "l_returnflag"], "l_extendedprice")


@query
def group_outlier_rows(spark, sf_dir):
    """Rows whose number of beds is far from that of the rows with as many bedrooms."""
    rows = _before(spark, sf_dir).select("id", "bedrooms", "beds")
    return group_outliers(rows, ["bedrooms"], "beds", cutoff=4.0, least=20)


@query
def local_outlier_rows(spark, sf_dir):
    """Rows with fewer than 20 others within 0.008 degrees."""
    rows = _before(spark, sf_dir).select("id", "latitude", "longitude")
    return local_outliers(rows, "latitude", "longitude", radius=0.008, least=20)


@query
def local_outlier_customers(spark, sf_dir):
    """Customers with fewer than 3 others within 50 in balance and nation (times 1000)."""
    rows = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", (F.col("c_nationkey") * 1000.0).alias("nation"))
    return local_outliers(rows, "c_acctbal", "nation", radius=50.0, least=3)


def _judged(spark, sf_dir):
    result = clean(dirty(spark, sf_dir), CONSISTENT_LISTINGS).save(fresh_scratch(spark, "reasoned"))
    return consistency.judged(result, consistency.learn(result.clean, CONSISTENT_LISTINGS))


@query
def consistency_bounds(spark, sf_dir):
    """The bounds learned from the clean rows, one row per ratio and group."""
    learned = consistency.learn(clean(dirty(spark, sf_dir), CONSISTENT_LISTINGS).clean, CONSISTENT_LISTINGS)
    parts = [limits.select(F.lit(r.reason).alias("reason"), "bedrooms", "low", "high") for r, limits, _ in learned.limits]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def consistency_reason_counts(spark, sf_dir):
    return _judged(spark, sf_dir).reason_counts()


@query
def consistency_rejected_rows(spark, sf_dir):
    return _judged(spark, sf_dir).rejected


def _consistent(spark, sf_dir, what):
    """One result of the experiment with all rules; its tables are deleted again, the result is checkpointed."""
    e = run_consistency_experiment(_staged(spark, dirty(spark, sf_dir)), CONSISTENT_LISTINGS, INJECTION)
    out = materialize(what(e))
    e.release()
    return out


@query
def consistency_recall(spark, sf_dir):
    """Recall per error type with the fixed rules, and with those that compare columns, groups and neighbours."""
    return _consistent(spark, sf_dir, lambda e: e.recall())


@query
def consistency_collateral(spark, sf_dir):
    return _consistent(spark, sf_dir, lambda e: e.collateral())


# --- profile state of slices (A3, A10 incremental; X3 drift) ---------------------------------------


@query
def incremental_profile(spark, sf_dir):
    """Three slices of dirty profiled one by one; the merged state against exact values of the whole table: distinct counts
    within three standard deviations, the rank of the median within the sketch's bound."""
    path, d = fresh_scratch(spark, "profile-state"), _staged(spark, dirty(spark, sf_dir))
    part = F.pmod(F.coalesce(typed_key("id"), F.lit(0)), F.lit(3))
    for i in range(3):
        add_slice(d.filter(part == i), path, f"day{i}")
    add_slice(d.filter(part == 2), path, "day2")   # a retried day replaces itself
    merged = merged_profile(spark, path, probs=(0.5,))
    exact = profile(d, approx=False, exact_distinct=True).select("column", "distinct_exact")
    middles = {r["column"]: r["q0_5"] for r in merged.select("column", "q0_5").collect()}   # one row per column
    v = {c: safe_cast(c, "double") for c in d.columns}
    ranks = d.agg(*[x for i, c in enumerate(d.columns) for x in (
        F.count(v[c]).alias(f"n{i}"), count_if(v[c] < F.lit(middles[c])).alias(f"l{i}"), count_if(v[c] <= F.lit(middles[c])).alias(f"h{i}"))])
    slack = lambda i: 0.017 * F.col(f"n{i}") + 1
    near = ranks.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), (
        (F.col(f"n{i}") == 0) | ((F.col(f"l{i}") <= 0.5 * F.col(f"n{i}") + slack(i)) & (F.col(f"h{i}") >= 0.5 * F.col(f"n{i}") - slack(i)))).alias("median_within"))
        for i, c in enumerate(d.columns)])))
    error = F.abs(F.col("distinct_approx") - F.col("distinct_exact"))
    both = merged.join(exact, "column").join(near, "column")
    return both.select("column", "rows", "missing_count", "missing_pct", "numeric_min", "numeric_max",
                       (error <= 3 * 0.01625 * F.col("distinct_exact")).alias("distinct_within"), "median_within")


@query
def profile_drift(spark, sf_dir):
    """Short stays against long ones, from the saved state of both (text buckets by md5, so that other engines can check)."""
    path, d = fresh_scratch(spark, "drift-state"), dirty(spark, sf_dir)
    short = F.coalesce(safe_cast("minimum_nights", "double") <= 14, F.lit(False))
    add_slice(d.filter(short), path, "short", text_hash="md5")
    for name, rows in (("long-1", d.filter(~short & (F.length("id") < 4))), ("long-2", d.filter(~short & ~(F.length("id") < 4)))):
        add_slice(rows, path, name, text_hash="md5")
    return drift(spark, path, ["short"], ["long-1", "long-2"])


@query
def missing_pairs(spark, sf_dir):
    return X.missing_pairs(dirty(spark, sf_dir))


# --- incremental staging, stateful streams (S4, X4) -----------------------------------------------


@query
def stage_incremental(spark, sf_dir):
    """CSV files that arrive in two deliveries; each call stages what is new."""
    folder, to, log = (fresh_scratch(spark, x) for x in ("deliveries", "staged", "staging-log"))
    rows = _dirty_with_note(spark, sf_dir)
    first = F.coalesce(F.length("id") % 2 == 0, F.lit(False))
    for part in (rows.filter(first), rows.filter(~first)):
        write_raw_csv(part, folder, mode="append")
        staged = stage_new(spark, folder, to, log, rows.columns)
    return normalize(staged)


DEDUP_GAP, DEDUP_DELAY = "6 hours", "1 day"


def _events(spark, sf_dir):
    """Events, every 97th without a user, every 10th once more five minutes later under another id."""
    e = read_table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_id") % 97 != 0, F.col("user_id")).alias("user_id"), "event_type", "value")
    again = e.filter("event_id % 10 = 3").withColumn("ts", F.col("ts") + F.expr("INTERVAL 5 MINUTES")).withColumn("event_id", F.col("event_id") + 10_000_000)
    return e.unionByName(again)


@query
def dedup_bursts(spark, sf_dir):
    """One event per burst of a user and type, as a batch."""
    return survivors(_events(spark, sf_dir), ["user_id", "event_type"], "ts", DEDUP_GAP).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_dedup_bursts(spark, sf_dir):
    """The same from a stream that is stopped and started again; a last event moves the watermark past all bursts."""
    e, landing = _events(spark, sf_dir), fresh_scratch(spark, "events")
    out, checkpoint = fresh_scratch(spark, "bursts"), fresh_scratch(spark, "bursts-checkpoint")
    cuts = e.agg(F.min("ts").alias("a"), F.max("ts").alias("z")).select("a", (F.col("a") + (F.col("z") - F.col("a")) / 2).alias("m"), "z").first()
    last = spark.createDataFrame([(-1,)], "event_id bigint").select(
        "event_id", (F.lit(cuts["z"]) + F.expr("INTERVAL 30 DAYS")).alias("ts"), F.lit(None).cast("bigint").alias("user_id"),
        F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("double").alias("value"))
    for rows in (e.filter(F.col("ts") < F.lit(cuts["m"])), e.filter(F.col("ts") >= F.lit(cuts["m"])), last):
        rows.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(e.schema).parquet(landing)
        start_dedup_stream(stream, out, checkpoint, ["user_id", "event_type"], "ts", DEDUP_GAP, DEDUP_DELAY, available_now=True).awaitTermination()
    found = spark.read.schema(e.schema).parquet(out).filter("event_id <> -1")
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_validation(spark, sf_dir):
    """The listing suite on dirty as a stream of several micro-batches: equal to the suite on the whole."""
    d, landing = dirty(spark, sf_dir), fresh_scratch(spark, "landing")
    d.repartition(6).write.parquet(landing)
    typed = minimal_typing(spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 2).parquet(landing), LISTINGS)
    rules, path = build_rules(typed.columns, LISTINGS), fresh_scratch(spark, "suite")
    start_validation_stream(typed, rules, path, fresh_scratch(spark, "suite-checkpoint"), available_now=True).awaitTermination()
    return running_result(spark, path, rules)
