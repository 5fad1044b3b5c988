"""DuckDB formulations of the catalog queries (the correctness oracles).

Written independently of the Spark code, in plain SQL over the driver's
tables.  Engine differences are guarded explicitly:

* DuckDB ``TRY_CAST('12.7' AS BIGINT)`` rounds, Spark returns NULL -> integer
  casts are guarded by a digits-only pattern;
* DuckDB ``TRY_CAST('2024' AS DATE)`` is NULL, Spark gives 2024-01-01 -> dates
  are guarded by a date-shaped pattern;
* ``regexp_replace`` replaces the first match only unless ``'g'`` is given;
* NULL ordering is written out in every ORDER BY.
"""

from __future__ import annotations

from tq.operators.explore import PRICE_FORMAT, PRICE_PROBS
from tq.sources.tables import DIRTY_SQL

SCORES = ["review_scores_rating", "review_scores_cleanliness", "review_scores_location"]
FLAGS = ["host_is_superhost", "has_availability"]
TEXT_COLS = ["id", "price", "beds", "bedrooms", "bathrooms", *SCORES, "first_review", "last_review",
             "latitude", "longitude", "host_about", "minimum_nights", *FLAGS, "calendar_updated"]
KEPT_COLS = TEXT_COLS[:-1]  # calendar_updated is blank in every row of dirty
DIGITS = r"^[0-9\s.,+-]+$"

DIRTY = f"dirty AS ({DIRTY_SQL})"
NORM = "norm AS (SELECT " + ", ".join(f"nullif(trim({c}), '') AS {c}" for c in TEXT_COLS) + " FROM dirty)"


def big(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^[+-]?[0-9]+$') THEN TRY_CAST({x} AS BIGINT) END"


def dbl(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def date(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN TRY_CAST({x} AS DATE) END"


def money(x: str) -> str:
    return dbl(f"regexp_replace({x}, '[$,]', '', 'g')")


# minimal typing ("before"): casts only
CASTS = {"id": big("id"), "price": money("price"), "first_review": date("first_review"),
         "last_review": date("last_review"),
         **{c: dbl(c) for c in ["beds", "bedrooms", "bathrooms", *SCORES, "latitude", "longitude", "minimum_nights"]}}
MINIMAL = "minimal AS (SELECT " + ", ".join(f"{CASTS.get(c, c)} AS {c}" for c in TEXT_COLS) + " FROM norm)"

# typed + repaired, empty column dropped
REPAIRED = {
    **CASTS,
    **{c: f"nullif({dbl(c)}, 0.0)" for c in SCORES},
    **{c: f"CASE {c} WHEN 't' THEN true WHEN 'f' THEN false END" for c in FLAGS},
    "host_about": f"CASE WHEN regexp_matches(host_about, '{DIGITS}') THEN NULL ELSE host_about END",
}
TYPED = ("typed AS (SELECT " + ", ".join([
    *[f"{REPAIRED[c]} AS {c}" for c in KEPT_COLS],
    f"{money('price')} IS NULL AS price_missing",
    f"{dbl('minimum_nights')} > 365 AS flag_minimum_nights_gt_365"]) + " FROM norm)")

TYPED_COLS = KEPT_COLS + ["price_missing", "flag_minimum_nights_gt_365"]
_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in TYPED_COLS if c != "id")
DEDUP = ("ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY " + _ORDER + ") AS rn FROM typed), "
         "deduped AS (SELECT * EXCLUDE (rn) FROM ranked WHERE id IS NULL OR rn = 1)")

REASON_TEXT = "concat_ws(',', " + ", ".join([
    "CASE WHEN id IS NULL THEN 'id_null_or_invalid' END",
    "CASE WHEN price <= 0 THEN 'price_not_positive' END",
    "CASE WHEN price > 10000 THEN 'price_too_high' END",
    "CASE WHEN beds > 20 THEN 'beds_too_high' END",
    "CASE WHEN bedrooms > 15 THEN 'bedrooms_too_high' END",
    "CASE WHEN bathrooms > 10 THEN 'bathrooms_too_high' END",
    *[f"CASE WHEN {c} < 0 OR {c} > 5 THEN '{c}_out_of_range' END" for c in SCORES],
    "CASE WHEN first_review > last_review THEN 'first_review_after_last_review' END",
    "CASE WHEN NOT (latitude BETWEEN 48.7 AND 49.0 AND longitude BETWEEN 2.1 AND 2.6) "
    "THEN 'coordinates_outside_box' END"]) + ")"
REASONS = f"reasoned AS (SELECT *, {REASON_TEXT} AS reject_reason FROM deduped)"

CLEAN_CHAIN = [DIRTY, NORM, TYPED, DEDUP, REASONS]


def with_(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def clean_sql(body: str, extra=()) -> str:
    return with_(CLEAN_CHAIN + list(extra), body)


ORACLES: dict[str, str] = {}

# --- clean + quarantine ------------------------------------------------------------------------

ORACLES["quarantine_reason_counts"] = clean_sql(
    "SELECT reason, CAST(count(*) AS BIGINT) AS n FROM "
    "(SELECT unnest(string_split(reject_reason, ',')) AS reason FROM reasoned WHERE reject_reason <> '') "
    "GROUP BY reason")

ORACLES["quarantine_clean_rows"] = clean_sql("SELECT * EXCLUDE (reject_reason) FROM reasoned WHERE reject_reason = ''")

ORACLES["quarantine_rejected_rows"] = clean_sql("SELECT * FROM reasoned WHERE reject_reason <> ''")

ORACLES["row_rules_reasons"] = clean_sql("SELECT * FROM reasoned")

METRICS_BODY = """
SELECT 'rows_in' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS value FROM norm
UNION ALL SELECT 'dropped_empty_columns', 'calendar_updated', 16
UNION ALL {lost}
UNION ALL SELECT 'score_zeros_set_to_null', NULL, CAST({zeros} AS BIGINT) FROM norm
UNION ALL SELECT 'numeric_text_set_to_null', 'host_about',
    CAST(count_if(regexp_matches(host_about, '{digits}')) AS BIGINT) FROM norm
UNION ALL SELECT 'rows_clean', NULL, CAST(count_if(reject_reason = '') AS BIGINT) FROM reasoned
UNION ALL SELECT 'rows_quarantined', NULL, CAST(count_if(reject_reason <> '') AS BIGINT) FROM reasoned
UNION ALL SELECT 'duplicate_keys_removed', NULL,
    CAST((SELECT count(*) FROM norm) - (SELECT count(*) FROM reasoned) AS BIGINT)
UNION ALL SELECT 'quarantine_reasons', reason, CAST(count(*) AS BIGINT) FROM
    (SELECT unnest(string_split(reject_reason, ',')) AS reason FROM reasoned WHERE reject_reason <> '')
    GROUP BY reason
""".format(digits=DIGITS, zeros=" + ".join(f"count_if({dbl(c)} = 0)" for c in SCORES), lost=" UNION ALL ".join(
    f"SELECT 'values_lost_in_conversion', '{c}', CAST(count_if({c} IS NOT NULL AND {x} IS NULL) AS BIGINT) FROM norm "
    f"HAVING count_if({c} IS NOT NULL AND {x} IS NULL) > 0" for c, x in CASTS.items()))
ORACLES["clean_metrics"] = clean_sql(METRICS_BODY)

ORACLES["row_reconciliation"] = clean_sql("""
SELECT rows_in, duplicates, rows_clean, rows_quarantined,
       rows_clean + rows_quarantined = rows_in - duplicates AS balanced
FROM (SELECT
  (SELECT CAST(count(*) AS BIGINT) FROM typed) AS rows_in,
  (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM
     (SELECT count(*) AS n FROM typed WHERE id IS NOT NULL GROUP BY id)) AS duplicates,
  (SELECT CAST(count_if(reject_reason = '') AS BIGINT) FROM reasoned) AS rows_clean,
  (SELECT CAST(count_if(reject_reason <> '') AS BIGINT) FROM reasoned) AS rows_quarantined)
""")

ORACLES["dedup_by_key_rows"] = clean_sql("SELECT * FROM deduped")

ORACLES["normalize_text_rows"] = with_([DIRTY, NORM], "SELECT * FROM norm")

ORACLES["blank_predicate"] = with_([DIRTY], "SELECT id AS raw_id, " + ", ".join(
    f"({c} IS NULL OR trim({c}) = '') AS {c}_blank" for c in TEXT_COLS) + " FROM dirty")

ORACLES["safe_cast_rows"] = with_([DIRTY, NORM], f"""
SELECT id AS raw_id, {big('id')} AS id, {dbl('beds')} AS beds, {date('first_review')} AS first_review,
       {dbl('latitude')} AS latitude, {dbl('price')} AS price_without_strip FROM norm""")

ORACLES["parse_currency_rows"] = with_([DIRTY, NORM], f"SELECT price AS price_text, {money('price')} AS price FROM norm")

ORACLES["parse_flag_rows"] = """
SELECT o_orderkey, lower(o_orderstatus) AS status_text,
       CASE WHEN lower(o_orderstatus) = 't' THEN true WHEN lower(o_orderstatus) = 'f' THEN false END AS status_flag
FROM orders"""

ORACLES["missing_indicator"] = clean_sql("SELECT id, price, price_missing FROM typed")

ORACLES["sentinel_to_null"] = clean_sql(f"""
SELECT (SELECT CAST(count_if({dbl('review_scores_rating')} = 0) AS BIGINT) FROM norm) AS zeros_set_to_null,
       (SELECT CAST(count_if(review_scores_rating IS NULL) AS BIGINT) FROM typed) AS null_scores,
       (SELECT CAST(count(review_scores_rating) AS BIGINT) FROM typed) AS scores""")

ORACLES["scrub_numeric_text"] = with_([DIRTY, NORM], f"""
SELECT id AS raw_id, host_about AS host_about_text,
       CASE WHEN regexp_matches(host_about, '{DIGITS}') THEN NULL ELSE host_about END AS host_about FROM norm""")

ORACLES["threshold_flag"] = clean_sql("SELECT id, minimum_nights, flag_minimum_nights_gt_365 FROM typed")

ORACLES["conversion_loss"] = with_([DIRTY, NORM], " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count_if({c} IS NOT NULL AND {expr} IS NULL) AS BIGINT) AS lost FROM norm"
    for c, expr in CASTS.items()))

ORACLES["minimal_typing_rows"] = with_([DIRTY, NORM, MINIMAL], "SELECT * FROM minimal")

ORACLES["drop_empty_columns"] = with_([DIRTY, NORM], " UNION ALL ".join(
    f"SELECT '{c}' AS column, {i} AS ordinal FROM norm HAVING count({c}) = 0" for i, c in enumerate(TEXT_COLS)))


# --- profile -------------------------------------------------------------------------------------

def profile_sql(table: str, columns, exact_distinct: bool = False, ctes=()) -> str:
    """columns: (name, kind) with kind text | num | other."""
    parts = []
    for i, spec in enumerate(columns):
        c, kind = spec[0], spec[1]
        i = spec[2] if len(spec) > 2 else i
        missing = f"({c} IS NULL OR trim({c}) = '')" if kind == "text" else f"{c} IS NULL"
        num = dbl(c) if kind == "text" else (f"CAST({c} AS DOUBLE)" if kind == "num" else "CAST(NULL AS DOUBLE)")
        sample = (f"substring(replace(min(nullif(trim({c}), '')), chr(10), ' '), 1, 30)" if kind == "text"
                  else "CAST(NULL AS VARCHAR)")
        extra = f", CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_exact" if exact_distinct else ""
        parts.append(
            f"SELECT '{c}' AS column, {i} AS ordinal, CAST(count(*) AS BIGINT) AS rows, "
            f"CAST(count_if({missing}) AS BIGINT) AS missing_count, "
            f"round(100.0 * count_if({missing}) / nullif(count(*), 0), 2) AS missing_pct, "
            f"min({num}) AS numeric_min, max({num}) AS numeric_max, {sample} AS sample_value{extra} FROM {table}")
    body = " UNION ALL ".join(parts)
    return with_(list(ctes), body) if ctes else body


DIRTY_PROFILE = [(c, "text") for c in TEXT_COLS]
LINEITEM_PROFILE = [("l_orderkey", "num"), ("l_partkey", "num"), ("l_suppkey", "num"), ("l_linenumber", "num"),
                    ("l_quantity", "num"), ("l_extendedprice", "num"), ("l_discount", "num"), ("l_tax", "num"),
                    ("l_returnflag", "text"), ("l_linestatus", "text"), ("l_shipdate", "other")]
DOCUMENTS_PROFILE = [("doc_id", "num"), ("text", "text"), ("lang", "text"), ("source", "text"), ("n_chars", "num")]

ORACLES["profile_table"] = with_([DIRTY], """
SELECT CAST(count(*) AS BIGINT) AS rows, 17 AS columns,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS BIGINT) AS duplicate_rows,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT id FROM dirty)) AS BIGINT) AS duplicate_keys
FROM dirty""")

ORACLES["profile_columns"] = profile_sql("dirty", DIRTY_PROFILE, ctes=[DIRTY])

ORACLES["profile_exact_distinct"] = with_([DIRTY], " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_exact FROM dirty" for c in TEXT_COLS))

ORACLES["profile_lineitem_columns"] = profile_sql("lineitem", LINEITEM_PROFILE, exact_distinct=True)

ORACLES["profile_documents_columns"] = profile_sql("documents", DOCUMENTS_PROFILE)

ORACLES["duplicate_rows_count"] = with_([DIRTY, "twice AS (SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE id LIKE '%7')"], """
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS BIGINT) AS duplicate_rows FROM twice""")

ORACLES["profile_approx_distinct"] = with_([DIRTY], " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_exact, true AS within_error FROM dirty"
    for c in TEXT_COLS))

ORACLES["duplicate_keys_count"] = with_([DIRTY], """
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT id FROM dirty)) AS BIGINT) AS duplicate_keys FROM dirty""")

ORACLES["empty_columns"] = with_([DIRTY, NORM], " UNION ALL ".join(
    f"SELECT '{c}' AS column, {i} AS ordinal, CAST(count({c}) AS BIGINT) AS non_null, count({c}) = 0 AS empty "
    f"FROM norm" for i, c in enumerate(TEXT_COLS)))

# --- exploration ---------------------------------------------------------------------------------

ORACLES["explore_format_check"] = with_([DIRTY, f"""bad AS (SELECT price AS v FROM dirty
    WHERE NOT (price IS NULL OR trim(price) = '') AND NOT regexp_matches(price, '{PRICE_FORMAT}'))"""], """
SELECT 'price' AS column, (SELECT CAST(count(*) AS BIGINT) FROM bad) AS bad_count,
       (SELECT coalesce(string_agg(v, ' | ' ORDER BY v), '') FROM
           (SELECT DISTINCT v FROM bad ORDER BY v LIMIT 5)) AS examples""")

ORACLES["explore_non_positive"] = with_([DIRTY], f"""
SELECT CAST(count_if({money('price')} <= 0) AS BIGINT) AS non_positive FROM dirty""")

ORACLES["explore_quantiles"] = with_([DIRTY], f"""
SELECT unnest({list(PRICE_PROBS)}::DOUBLE[]) AS probability,
       unnest(quantile_disc(CASE WHEN price = 'n/a' THEN 'infinity'::DOUBLE ELSE {money('price')} END, {list(PRICE_PROBS)}))
       AS value FROM dirty""")

ORACLES["explore_quantiles_approx"] = f"SELECT unnest({list(PRICE_PROBS)}::DOUBLE[]) AS probability, true AS within_error"

ORACLES["explore_top_values"] = with_([DIRTY], f"""
SELECT id, {money('price')} AS price_num FROM dirty
ORDER BY price_num DESC NULLS LAST, id ASC NULLS FIRST LIMIT 5""")

ORACLES["explore_cross_missing"] = with_([DIRTY], """
SELECT CAST(count_if((price IS NULL OR trim(price) = '') AND NOT (review_scores_rating IS NULL
            OR trim(review_scores_rating) = '')) AS BIGINT) AS price_missing_review_scores_rating_present,
       CAST(count_if(NOT (price IS NULL OR trim(price) = '') AND (review_scores_rating IS NULL
            OR trim(review_scores_rating) = '')) AS BIGINT) AS price_present_review_scores_rating_missing
FROM dirty""")

ORACLES["explore_extremes"] = with_([DIRTY, f"""long AS (
    SELECT 'beds' AS "column", id, {dbl('beds')} AS v FROM dirty
    UNION ALL SELECT 'minimum_nights', id, {dbl('minimum_nights')} FROM dirty)"""], """
SELECT "column", 'top' || CAST(rk AS VARCHAR) AS stat, v AS value, id FROM (
    SELECT "column", id, v, row_number() OVER (PARTITION BY "column" ORDER BY v DESC, id ASC NULLS FIRST) AS rk
    FROM long WHERE v IS NOT NULL) WHERE rk <= 5
UNION ALL
SELECT "column", 'p' || CAST(p AS VARCHAR) AS stat, q AS value, CAST(NULL AS VARCHAR) AS id FROM (
    SELECT "column", unnest([0.5, 0.99, 0.999]::DOUBLE[]) AS p, unnest(quantile_disc(v, [0.5, 0.99, 0.999])) AS q
    FROM long GROUP BY "column")""")

ORACLES["explore_score_ranges"] = with_([DIRTY], " UNION ALL ".join(f"""
SELECT '{c}' AS column, CAST(count_if({dbl(c)} < 0 OR {dbl(c)} > 5) AS BIGINT) AS out_of_range,
       CAST(count_if({dbl(c)} = 0) AS BIGINT) AS zeros FROM dirty""" for c in SCORES))

ORACLES["explore_date_order"] = with_([DIRTY], f"""
SELECT CAST(count_if({date('first_review')} > {date('last_review')}) AS BIGINT) AS inverted_pairs,
       CAST(count_if(NOT (first_review IS NULL OR trim(first_review) = '') AND {date('first_review')} IS NULL)
            AS BIGINT) AS unparseable_first_review FROM dirty""")

ORACLES["explore_outside_box"] = with_([DIRTY], f"""
SELECT CAST(count_if({dbl('latitude')} IS NOT NULL AND {dbl('longitude')} IS NOT NULL AND NOT
       ({dbl('latitude')} BETWEEN 48.7 AND 49.0 AND {dbl('longitude')} BETWEEN 2.1 AND 2.6)) AS BIGINT)
       AS outside_box FROM dirty""")

ORACLES["explore_numeric_text"] = with_([DIRTY], f"""
SELECT CAST(count_if(regexp_matches(host_about, '{DIGITS}')) AS BIGINT) AS numeric_text FROM dirty""")


# --- expectations --------------------------------------------------------------------------------

def rule_sql(i, label, kind, table, c, *, low=None, high=None, strict_low=False, other=None, or_equal=True,
             regex=None, mostly=None) -> str:
    """(u, d) for one rule, as a SELECT producing the result row."""
    if kind == "not_null":
        u, d = f"count_if({c} IS NULL)", "count(*)"
        src = table
    elif kind == "between":
        conds = []
        if low is not None:
            conds.append(f"{c} {'>' if strict_low else '>='} {float(low)}")
        if high is not None:
            conds.append(f"{c} <= {float(high)}")
        u, d = f"count_if({c} IS NOT NULL AND NOT ({' AND '.join(conds)}))", f"count({c})"
        src = table
    elif kind == "pair_order":
        op = ">=" if or_equal else ">"
        u = f"count_if(NOT ({c} {op} {other}))"
        d = f"count_if(NOT ({c} IS NULL AND {other} IS NULL))"
        src = table
    elif kind == "not_match_regex":
        u, d = f"count_if(regexp_matches({c}, '{regex}'))", f"count({c})"
        src = table
    elif kind == "unique":
        u, d = "coalesce(sum(CASE WHEN n > 1 THEN n END), 0)", "coalesce(sum(n), 0)"
        src = f"(SELECT count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c})"
    else:
        raise ValueError(kind)
    rows = f"(SELECT count(*) FROM {table})"
    if mostly is None:
        success = "u = 0"
    else:
        success = f"(d = 0 OR coalesce(1.0::DOUBLE - u::DOUBLE / d::DOUBLE >= {mostly}, false))"
    return (f"SELECT {i} AS ordinal, '{label}' AS rule, '{kind}' AS expectation, '{c}' AS \"column\", "
            f"{success} AS success, u AS unexpected_count, "
            f"round(100.0::DOUBLE * u::DOUBLE / nullif(d, 0)::DOUBLE, 3) AS unexpected_percent, "
            f"checked_rows FROM (SELECT CAST({u} AS BIGINT) AS u, CAST({d} AS BIGINT) AS d, "
            f"CAST({rows} AS BIGINT) AS checked_rows FROM {src})")


def suite_sql(table, rules) -> str:
    return " UNION ALL ".join(rule_sql(i, *r[:2], table, r[2], **(r[3] if len(r) > 3 else {}))
                              for i, r in enumerate(rules))


SCORE = "review_scores_rating"
LISTING_SUITE = [
    ("id not null", "not_null", "id"),
    ("id unique", "unique", "id"),
    ("price in ]0, 10000]", "between", "price", dict(low=0, high=10000, strict_low=True)),
    ("price present in at least 95 % of rows", "not_null", "price", dict(mostly=0.95)),
    ("beds in [0, 20]", "between", "beds", dict(low=0, high=20)),
    ("bedrooms in [0, 15]", "between", "bedrooms", dict(low=0, high=15)),
    ("bathrooms in [0, 10]", "between", "bathrooms", dict(low=0, high=10)),
    *[(f"{c} in ]0, 5]", "between", c, dict(low=0, high=5, strict_low=True)) for c in sorted(SCORES)],
    ("last_review >= first_review", "pair_order", "last_review", dict(other="first_review")),
    ("latitude inside the box", "between", "latitude", dict(low=48.7, high=49.0)),
    ("longitude inside the box", "between", "longitude", dict(low=2.1, high=2.6)),
    ("host_about not only digits", "not_match_regex", "host_about", dict(regex=DIGITS)),
]
CLEAN_ROWS = "clean_rows AS (SELECT * EXCLUDE (reject_reason) FROM reasoned WHERE reject_reason = '')"

ORACLES["validate_suite"] = clean_sql(suite_sql("clean_rows", LISTING_SUITE), extra=[CLEAN_ROWS])

ORACLES["expect_not_null"] = with_([DIRTY, NORM, MINIMAL], suite_sql("minimal", [
    ("price not null", "not_null", "price"), ("beds not null", "not_null", "beds")]))

ORACLES["expect_unique"] = with_([DIRTY, NORM, MINIMAL], suite_sql("minimal", [
    ("id unique", "unique", "id"), ("host_about unique", "unique", "host_about")]))

ORACLES["expect_between"] = with_([DIRTY, NORM, MINIMAL], suite_sql("minimal", [
    ("price in ]0, 10000]", "between", "price", dict(low=0, high=10000, strict_low=True)),
    ("beds in [0, 20]", "between", "beds", dict(low=0, high=20)),
    (f"{SCORE} in ]0, 5]", "between", SCORE, dict(low=0, high=5, strict_low=True))]))

ORACLES["expect_pair_order"] = with_([DIRTY, NORM, MINIMAL], suite_sql("minimal", [
    ("last_review >= first_review", "pair_order", "last_review", dict(other="first_review")),
    ("last_review > first_review", "pair_order", "last_review", dict(other="first_review", or_equal=False))]))

ORACLES["expect_not_match_regex"] = with_([DIRTY, NORM, MINIMAL], suite_sql("minimal", [
    ("host_about not only digits", "not_match_regex", "host_about", dict(regex=DIGITS))]))

ORACLES["expect_mostly"] = with_([DIRTY, NORM, MINIMAL], suite_sql("minimal", [
    ("price present in at least 95 % of rows", "not_null", "price", dict(mostly=0.95)),
    ("beds present in at least 80 % of rows", "not_null", "beds", dict(mostly=0.80))]))

ORACLES["validate_customer"] = suite_sql("customer", [
    ("c_custkey not null", "not_null", "c_custkey"), ("c_custkey unique", "unique", "c_custkey"),
    ("c_acctbal in [0, 10000]", "between", "c_acctbal", dict(low=0, high=10000)),
    ("c_name unique", "unique", "c_name")])

_BEFORE_AFTER_CTES = CLEAN_CHAIN + [CLEAN_ROWS, MINIMAL,
                                    f"b AS ({suite_sql('minimal', LISTING_SUITE)})",
                                    f"a AS ({suite_sql('clean_rows', LISTING_SUITE)})"]


def _status(p):
    return (f"CASE WHEN coalesce({p}.unexpected_count, 0) > 0 THEN "
            f"(CASE WHEN {p}.success THEN 'PASS' ELSE 'FAIL' END) || ' (' || CAST({p}.unexpected_count AS VARCHAR) "
            f"|| ' rows, ' || coalesce(CAST({p}.unexpected_percent AS VARCHAR), 'n/a') || ' %)' "
            f"ELSE (CASE WHEN {p}.success THEN 'PASS' ELSE 'FAIL' END) END")


ORACLES["validate_before_after"] = with_(_BEFORE_AFTER_CTES, """
SELECT b.ordinal, b.rule, b.expectation, b."column",
       b.success AS before_success, b.unexpected_count AS before_unexpected_count,
       b.unexpected_percent AS before_unexpected_percent, b.checked_rows AS before_checked_rows,
       a.success AS after_success, a.unexpected_count AS after_unexpected_count,
       a.unexpected_percent AS after_unexpected_percent, a.checked_rows AS after_checked_rows
FROM b JOIN a USING (ordinal)""")

ORACLES["validate_status_text"] = with_(_BEFORE_AFTER_CTES, f"""
SELECT b.ordinal, b.rule, {_status('b')} AS before_status, {_status('a')} AS after_status
FROM b JOIN a USING (ordinal)""")

def _empties(table, cols):
    return (f"(SELECT CAST(" + " + ".join(f"CAST(count({c}) = 0 AS INTEGER)" for c in cols)
            + f" AS INTEGER) FROM {table})")


ORACLES["validate_summary"] = with_(_BEFORE_AFTER_CTES, f"""
SELECT 'before' AS side, (SELECT CAST(count(*) AS BIGINT) FROM minimal) AS rows, {len(TEXT_COLS)} AS columns,
       {_empties('minimal', TEXT_COLS)} AS fully_empty_columns,
       (SELECT CAST(count_if(success) AS BIGINT) FROM b) AS rules_passed, {len(LISTING_SUITE)} AS rules_total
UNION ALL
SELECT 'after', (SELECT CAST(count(*) AS BIGINT) FROM clean_rows), {len(TYPED_COLS)},
       {_empties('clean_rows', TYPED_COLS)}, (SELECT CAST(count_if(success) AS BIGINT) FROM a), {len(LISTING_SUITE)}""")



# --- injection and detection ---------------------------------------------------------------------

def clean_chain(src: str, sfx: str):
    """The clean CTE chain over another source, with suffixed CTE names."""
    out = []
    for cte in (NORM, TYPED, DEDUP, REASONS):
        for name in ("norm", "typed", "ranked", "deduped", "reasoned"):
            cte = cte.replace(f"{name} AS (", f"{name}{sfx} AS (").replace(f"FROM {name})", f"FROM {name}{sfx})") \
                     .replace(f"FROM {name} ", f"FROM {name}{sfx} ").replace(f"FROM {name}\n", f"FROM {name}{sfx}\n")
        out.append(cte.replace("FROM dirty)", f"FROM {src})"))
    return out


N_INJ, SEED = 500, 42
TYPE_NAMES = ["price_x100", "price_negative", "beds_extra_digit", "rating_above_5", "dates_swapped",
              "gps_far_shift", "gps_small_shift", "host_about_phone", "duplicate_rows"]
RAW_KEY = big("nullif(trim(id), '')")
POOLS = [
    f"{money('price')} > 0",
    f"{money('price')} > 0",
    f"{dbl('beds')} >= 1",
    f"{dbl(SCORE)} BETWEEN 1 AND 5",
    f"{date('first_review')} < {date('last_review')}",
    f"{dbl('latitude')} IS NOT NULL",
    f"{dbl('latitude')} IS NOT NULL",
    f"host_about IS NOT NULL AND trim(host_about) <> '' AND NOT regexp_matches(host_about, '{DIGITS}')",
    "true",
]
_steps = [f"s0 AS MATERIALIZED (SELECT *, CAST(NULL AS INTEGER) AS taken FROM elig)"]
for t in range(1, 10):
    _steps.append(
        f"s{t} AS MATERIALIZED (SELECT * EXCLUDE (rk, taken), CASE WHEN e{t} AND taken IS NULL AND rk <= {N_INJ} "
        f"THEN {t} ELSE taken END AS taken FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY (e{t} AND taken IS NULL) ORDER BY h, id) AS rk FROM s{t - 1}))")
_names = "[" + ", ".join(f"'{n}'" for n in TYPE_NAMES) + "]"
ASSIGN = [
    "valid AS (SELECT DISTINCT id FROM reasoned WHERE reject_reason = '')",
    f"raw_k AS (SELECT *, {RAW_KEY} AS k FROM dirty)",
    "base AS (SELECT * FROM raw_k WHERE k IN (SELECT id FROM valid))",
    "elig AS (SELECT k AS id, CAST(k AS VARCHAR) AS key_text, md5(CAST(k AS VARCHAR) || ':" + str(SEED) + "') AS h, "
    + ", ".join(f"bool_or(coalesce({p}, false)) AS e{i + 1}" for i, p in enumerate(POOLS)) + " FROM base GROUP BY k)",
    *_steps,
    f"assignments AS (SELECT id, key_text, {_names}[taken] AS error_type FROM s9 WHERE taken IS NOT NULL)",
]
_LAT = dbl("latitude")
CORRUPT = [
    "tagged AS (SELECT r.* EXCLUDE (k), a.error_type AS et FROM raw_k r LEFT JOIN assignments a ON r.k = a.id)",
    "corrupted AS (SELECT * REPLACE ("
    f"CASE et WHEN 'price_x100' THEN '$' || format('{{:,.2f}}', {money('price')} * 100) "
    "WHEN 'price_negative' THEN '$-' || regexp_replace(price, '^\\$', '') ELSE price END AS price, "
    f"CASE WHEN et = 'beds_extra_digit' THEN CAST(CAST(trunc({dbl('beds')}) AS INTEGER) AS VARCHAR) || '3' "
    "ELSE beds END AS beds, "
    f"CASE WHEN et = 'rating_above_5' THEN '7.5' ELSE {SCORE} END AS {SCORE}, "
    "CASE WHEN et = 'dates_swapped' THEN last_review ELSE first_review END AS first_review, "
    "CASE WHEN et = 'dates_swapped' THEN first_review ELSE last_review END AS last_review, "
    f"CASE et WHEN 'gps_far_shift' THEN CAST({_LAT} + 5.0 AS VARCHAR) "
    f"WHEN 'gps_small_shift' THEN CAST({_LAT} + 0.05 AS VARCHAR) ELSE latitude END AS latitude, "
    "CASE WHEN et = 'host_about_phone' THEN '0612345678' ELSE host_about END AS host_about) FROM tagged)",
    "corrupted_all AS (SELECT * EXCLUDE (et) FROM corrupted UNION ALL "
    "SELECT * EXCLUDE (et) FROM corrupted WHERE et = 'duplicate_rows')",
]
INJECT_CHAIN = CLEAN_CHAIN + ASSIGN + CORRUPT

ORACLES["valid_rows_semi_join"] = with_(CLEAN_CHAIN + ASSIGN[:3], "SELECT * EXCLUDE (k) FROM base")

ORACLES["unused_rows_anti_join"] = with_(CLEAN_CHAIN + ASSIGN,
                                         "SELECT * EXCLUDE (k) FROM base WHERE k NOT IN (SELECT id FROM assignments)")

ORACLES["seeded_sample"] = with_([DIRTY], f"""
SELECT id, key_text, h FROM (SELECT DISTINCT {RAW_KEY} AS id FROM dirty) q,
    LATERAL (SELECT CAST(q.id AS VARCHAR) AS key_text, md5(CAST(q.id AS VARCHAR) || ':{SEED}') AS h)
WHERE id IS NOT NULL ORDER BY h, id LIMIT {N_INJ}""")

ORACLES["seeded_sample_xxhash"] = with_([DIRTY], f"""
SELECT least({N_INJ}, count(DISTINCT {RAW_KEY})) AS sampled, true AS all_distinct, true AS smallest, true AS repeatable
FROM dirty""")

ORACLES["inject_assignments"] = with_(CLEAN_CHAIN + ASSIGN, "SELECT * FROM assignments")

_TYPE_COLS = {"price_x100": ["price"], "price_negative": ["price"], "beds_extra_digit": ["beds"],
              "rating_above_5": [SCORE], "dates_swapped": ["first_review", "last_review"],
              "gps_far_shift": ["latitude"], "gps_small_shift": ["latitude"], "host_about_phone": ["host_about"]}
for _name, _cols in _TYPE_COLS.items():
    ORACLES[f"inject_{_name}"] = with_(INJECT_CHAIN, f"""
SELECT {RAW_KEY} AS key, id, {', '.join(_cols)} FROM corrupted_all
WHERE {RAW_KEY} IN (SELECT id FROM assignments WHERE error_type = '{_name}')""")

ORACLES["inject_duplicate_rows"] = with_(INJECT_CHAIN, f"""
SELECT {RAW_KEY} AS key, CAST(count(*) AS BIGINT) AS copies FROM corrupted_all
WHERE {RAW_KEY} IN (SELECT id FROM assignments WHERE error_type = 'duplicate_rows') GROUP BY 1""")

_OTHER = {"id": "listing_id", "price": "cost", "beds": "places", "review_scores_rating": "review_scores_total",
          "first_review": "opened", "last_review": "seen", "latitude": "north", "longitude": "east", "host_about": "about"}
ORACLES["inject_other_key"] = with_(INJECT_CHAIN, "SELECT " + ", ".join(
    f"{c} AS {_OTHER.get(c, c)}" for c in TEXT_COLS) + " FROM corrupted_all")

ORACLES["inject_all"] = with_(INJECT_CHAIN, "SELECT * FROM corrupted_all")

_REGISTRY = """registry AS (SELECT * FROM (VALUES
  ('price_x100', 'Price multiplied by 100', 'quarantine', 'price_too_high', 0),
  ('price_negative', 'Price made negative', 'quarantine', 'price_not_positive', 1),
  ('beds_extra_digit', 'Extra digit typed in beds (2 becomes 23)', 'quarantine', 'beds_too_high', 2),
  ('rating_above_5', 'Review rating set to 7.5', 'quarantine', 'review_scores_rating_out_of_range', 3),
  ('dates_swapped', 'first_review and last_review swapped', 'quarantine', 'first_review_after_last_review', 4),
  ('gps_far_shift', 'Latitude shifted by 5 degrees (about 550 km)', 'quarantine', 'coordinates_outside_box', 5),
  ('gps_small_shift', 'Latitude shifted by 0.05 degrees (about 5 km)', 'quarantine', 'coordinates_outside_box', 6),
  ('host_about_phone', 'Free text replaced by a phone number', 'nullified', NULL, 7),
  ('duplicate_rows', 'Row duplicated (same id)', 'duplicates', NULL, 8)
) t(error_type, description, detection, reason, ordinal))"""
_DETECT = INJECT_CHAIN + clean_chain("corrupted_all", "2") + [_REGISTRY, """growth AS (SELECT
  ((SELECT count(*) FROM corrupted_all) - (SELECT count(*) FROM reasoned2))
  - ((SELECT count(*) FROM dirty) - (SELECT count(*) FROM reasoned)) AS g)""", """per_type AS (
SELECT a.error_type, r.description, r.ordinal, r.detection, count(*) AS injected,
  count_if(CASE r.detection
      WHEN 'quarantine' THEN coalesce(x.reject_reason <> '' AND
                                      list_contains(string_split(x.reject_reason, ','), r.reason), false)
      WHEN 'nullified' THEN coalesce(x.reject_reason = '' AND x.host_about IS NULL, false)
      ELSE false END) AS detected
FROM assignments a JOIN registry r USING (error_type) LEFT JOIN reasoned2 x ON x.id = a.id
GROUP BY a.error_type, r.description, r.ordinal, r.detection)""", """recall AS (
SELECT error_type, description, CAST(injected AS BIGINT) AS injected,
  CAST(CASE WHEN detection = 'duplicates' THEN least(injected, (SELECT g FROM growth)) ELSE detected END AS BIGINT)
  AS detected, ordinal FROM per_type)"""]

ORACLES["detection_recall"] = with_(_DETECT, """
SELECT *, round(100.0::DOUBLE * detected / injected, 1) AS recall_pct FROM recall""")

ORACLES["detection_overall"] = with_(_DETECT, """
SELECT CAST(sum(injected) AS BIGINT) AS total_injected, CAST(sum(detected) AS BIGINT) AS total_detected,
       round(100.0::DOUBLE * sum(detected) / nullif(sum(injected), 0), 1) AS overall_recall_pct FROM recall""")

ORACLES["collateral_rows"] = with_(_DETECT, """
SELECT CAST(count(*) AS BIGINT) AS collateral_rows FROM (
  SELECT DISTINCT id FROM reasoned2 WHERE reject_reason <> '' AND id IS NOT NULL
  EXCEPT SELECT id FROM assignments
  EXCEPT SELECT id FROM reasoned WHERE reject_reason <> '' AND id IS NOT NULL)""")



# --- sources and sinks ---------------------------------------------------------------------------

NOTE = "note AS (SELECT *, 'He said \"ok\" for ' || coalesce(id, 'none') || chr(10) || 'second line' AS note FROM dirty)"
ORACLES["scan_csv_roundtrip"] = with_([DIRTY, NOTE], "SELECT " + ", ".join(
    f"nullif(trim({c}), '') AS {c}" for c in TEXT_COLS + ["note"]) + " FROM note")
ORACLES["stage_raw"] = ORACLES["scan_csv_roundtrip"]
ORACLES["clean_output_parquet"] = ORACLES["quarantine_clean_rows"]
ORACLES["quarantine_output_parquet"] = ORACLES["quarantine_rejected_rows"]
ORACLES["clean_metrics_json"] = ORACLES["clean_metrics"]
_MISSING = " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS c, CAST(count_if({c} IS NULL OR trim({c}) = '') AS BIGINT) AS missing_count, "
    f"round(100.0 * count_if({c} IS NULL OR trim({c}) = '') / count(*), 2) AS pct FROM dirty" for i, c in enumerate(TEXT_COLS))
ORACLES["profile_report_csv"] = with_([DIRTY], f"""
SELECT row_number() OVER (ORDER BY pct DESC, ordinal) - 1 AS place, c AS "column", missing_count FROM ({_MISSING})""")
ORACLES["validation_report_json"] = ORACLES["validate_status_text"]
ORACLES["recall_report_json"] = ORACLES["detection_recall"]
ORACLES["pipeline_run"] = with_(_BEFORE_AFTER_CTES, f"""
SELECT * FROM ({METRICS_BODY})
UNION ALL SELECT 'missing', c, missing_count FROM ({_MISSING} UNION ALL SELECT 99, 'note', 0, 0.0)
UNION ALL SELECT 'rules_passed', 'before', CAST(count_if(success) AS BIGINT) FROM b
UNION ALL SELECT 'rules_passed', 'after', CAST(count_if(success) AS BIGINT) FROM a""")

# --- offending rows --------------------------------------------------------------------------------

ORACLES["expect_unique_rows"] = with_([DIRTY, NORM, MINIMAL], """
SELECT * FROM minimal WHERE id IN (SELECT id FROM minimal WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)""")

ORACLES["expect_between_rows"] = with_([DIRTY, NORM, MINIMAL], """
SELECT * FROM minimal WHERE price IS NOT NULL AND NOT (price > 0 AND price <= 10000)""")

ORACLES["expect_pair_order_rows"] = with_([DIRTY, NORM, MINIMAL], """
SELECT * FROM minimal WHERE NOT (last_review >= first_review)""")

# --- streaming row rules: typed + reasons, no empty-column drop, no dedup ----------------------------

_STREAM_TYPED = TYPED.replace("typed AS (SELECT ", "stream_typed AS (SELECT ").replace(
    " FROM norm)", ", calendar_updated FROM norm)")
ORACLES["stream_row_rules"] = with_([DIRTY, NORM, _STREAM_TYPED], f"""
SELECT *, reject_reason <> '' AS quarantined FROM (SELECT *, {REASON_TEXT} AS reject_reason FROM stream_typed)""")


# --- rules configured for line items --------------------------------------------------------------

LINE_ITEMS = """line_items AS (SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_discount, l.l_returnflag,
    l.l_shipdate, o.o_orderdate FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
ORACLES["line_item_reason_counts"] = with_([LINE_ITEMS], """
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest([CASE WHEN l_quantity > 50 THEN 'l_quantity_too_high' END,
                 CASE WHEN l_discount > 0.1 THEN 'l_discount_too_high' END,
                 CASE WHEN o_orderdate > l_shipdate THEN 'o_orderdate_after_l_shipdate' END]) AS reason
  FROM line_items) WHERE reason IS NOT NULL GROUP BY reason""")
ORACLES["line_item_suite"] = suite_sql("line_items", [
    ("l_quantity in [1, 50]", "between", "l_quantity", dict(low=1, high=50)),
    ("l_discount in [0, 0.1]", "between", "l_discount", dict(low=0, high=0.1)),
    ("l_shipdate >= o_orderdate", "pair_order", "l_shipdate", dict(other="o_orderdate")),
    ("l_returnflag not null", "not_null", "l_returnflag"), ("the order exists", "not_null", "o_orderdate")])
ORACLES["line_item_suite"] = with_([LINE_ITEMS], ORACLES["line_item_suite"])


# --- profiles of more driver tables ---------------------------------------------------------------

ORACLES["profile_events_columns"] = profile_sql("events", [
    ("event_id", "num"), ("ts", "other"), ("user_id", "num"), ("event_type", "text"), ("value", "num"),
    ("props", "text")], exact_distinct=True)
ORACLES["profile_conversations_columns"] = profile_sql("conversations", [
    ("conv_id", "num"), ("turn", "num"), ("role", "text"), ("text", "text")])
ORACLES["profile_pages_columns"] = profile_sql("pages", [("page_id", "num"), ("url", "text"), ("html", "text")])
ORACLES["profile_embeddings_columns"] = profile_sql("embeddings", [("vec_id", "num"), ("embedding", "other"), ("label", "num")],
                                                    exact_distinct=True)

ORACLES["validate_documents"] = suite_sql("documents", [
    ("doc_id unique", "unique", "doc_id"), ("text unique", "unique", "text"), ("text not null", "not_null", "text"),
    ("n_chars in [1, 20000]", "between", "n_chars", dict(low=1, high=20000)),
    ("lang is a two-letter code", "not_match_regex", "lang", dict(regex="[^a-z]"))])
ORACLES["validate_labels"] = suite_sql("labels", [
    ("doc_id unique", "unique", "doc_id"),
    ("quality in [0, 1]", "between", "quality", dict(low=0, high=1)),
    ("toxic in [0, 1]", "between", "toxic", dict(low=0, high=1)),
    ("quality present in at least 99 % of rows", "not_null", "quality", dict(mostly=0.99))])


# --- groups, neighbours and columns compared -----------------------------------------------------

BEFORE_CHAIN = [DIRTY, NORM, MINIMAL]
ORACLES["group_spread"] = with_(BEFORE_CHAIN, """
SELECT bedrooms, count(price) AS n, median(price) AS median, mad(price) AS mad FROM minimal WHERE price IS NOT NULL GROUP BY bedrooms""")
ORACLES["group_spread_parts"] = """
SELECT l_partkey, l_returnflag, count(*) AS n, median(l_extendedprice::DOUBLE) AS median, mad(l_extendedprice::DOUBLE) AS mad
FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_partkey, l_returnflag"""
ORACLES["group_outlier_rows"] = with_(BEFORE_CHAIN, """
SELECT id, m.bedrooms, beds FROM minimal m JOIN (
  SELECT bedrooms, median(beds) AS mid, mad(beds) AS d, count(beds) AS n FROM minimal GROUP BY bedrooms) g
ON m.bedrooms IS NOT DISTINCT FROM g.bedrooms
WHERE g.n >= 20 AND g.d > 0 AND (beds < mid - 4 * d OR beds > mid + 4 * d)""")


def lonely_sql(source: str, x: str, y: str, radius: float, least: int) -> str:
    """Places of ``source`` with fewer than ``least`` other rows within ``radius``, by comparing all places."""
    return f"""(WITH p AS (SELECT {x} AS x, {y} AS y, count(*) AS n FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY ALL)
  SELECT a.x, a.y, CAST(sum(b.n) - 1 AS BIGINT) AS neighbours FROM p a JOIN p b
  ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {radius}::DOUBLE * {radius}::DOUBLE GROUP BY a.x, a.y HAVING sum(b.n) - 1 < {least})"""


ORACLES["local_outlier_rows"] = with_(BEFORE_CHAIN, f"""
SELECT id, latitude, longitude, neighbours FROM minimal m JOIN {lonely_sql('minimal', 'latitude', 'longitude', 0.008, 20)} l
ON m.latitude = l.x AND m.longitude = l.y""")
ORACLES["local_outlier_customers"] = f"""
WITH c AS (SELECT c_custkey, c_acctbal, c_nationkey * 1000.0::DOUBLE AS nation FROM customer)
SELECT c.*, neighbours FROM c JOIN {lonely_sql('c', 'c_acctbal', 'nation', 50.0, 3)} l ON c.c_acctbal = l.x AND c.nation = l.y"""

_RATIOS = [("price", "price_unusual_for_bedrooms"), ("price / nullif(bedrooms, 0.0)", "price_per_bedrooms_unusual_for_bedrooms"),
           ("beds", "beds_unusual_for_bedrooms")]


def consistent_chain(sfx: str) -> list[str]:
    """Every row of ``reasoned<sfx>`` with the text of all its reasons; the bounds come from the clean rows of ``reasoned``."""
    far = [f"coalesce({v} < b{i}.low OR {v} > b{i}.high, false) AS f{i}" for i, (v, _) in enumerate(_RATIOS)]
    joins = [f"LEFT JOIN bounds{i} b{i} ON r.bedrooms IS NOT DISTINCT FROM b{i}.bedrooms" for i in range(len(_RATIOS))]
    far = [x.replace("price", "r.price").replace("bedrooms", "r.bedrooms").replace("beds ", "r.beds ") for x in far]
    texts = ", ".join(f"CASE WHEN f{i} THEN '{reason}' END" for i, (_, reason) in enumerate(_RATIOS))
    return [
        f"related{sfx} AS (SELECT *, concat_ws(',', nullif(reject_reason, ''), "
        f"CASE WHEN beds > 2 * bedrooms + 10 THEN 'beds_far_above_bedrooms' END) AS rr FROM reasoned{sfx})",
        *([f"bounds{i} AS (SELECT bedrooms, m - 4.0 * d AS low, m + 4.0 * d AS high FROM (SELECT bedrooms, count({v}) AS n, median({v}) AS m, "
           f"mad({v}) AS d FROM related WHERE rr = '' GROUP BY bedrooms) WHERE n >= 20 AND d > 0)" for i, (v, _) in enumerate(_RATIOS)] if not sfx else []),
        f"flagged{sfx} AS (SELECT r.*, {', '.join(far)} FROM related{sfx} r {' '.join(joins)})",
        f"sound{sfx} AS (SELECT * FROM flagged{sfx} WHERE rr = '' AND NOT f0 AND NOT f1 AND NOT f2)",
        f"lonely{sfx} AS {lonely_sql(f'sound{sfx}', 'latitude', 'longitude', 0.008, 100)}",
        f"judged{sfx} AS (SELECT f.* EXCLUDE (reject_reason, rr, f0, f1, f2), concat_ws(',', nullif(rr, ''), {texts}, "
        f"CASE WHEN l.x IS NOT NULL THEN 'coordinates_isolated' END) AS reject_reason "
        f"FROM flagged{sfx} f LEFT JOIN lonely{sfx} l ON f.latitude = l.x AND f.longitude = l.y)",
    ]


ORACLES["consistency_bounds"] = clean_sql(" UNION ALL ".join(
    f"SELECT '{reason}' AS reason, bedrooms, low, high FROM bounds{i}" for i, (_, reason) in enumerate(_RATIOS)), consistent_chain(""))
ORACLES["consistency_reason_counts"] = clean_sql(
    "SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(reject_reason, ',')) AS reason FROM judged "
    "WHERE reject_reason <> '') GROUP BY reason", consistent_chain(""))
ORACLES["consistency_rejected_rows"] = clean_sql("SELECT * FROM judged WHERE reject_reason <> ''", consistent_chain(""))

_PRICE, _PLACE = [r for _, r in _RATIOS[:2]], ["coordinates_isolated"]
_MORE = {"price_x100": _PRICE, "price_negative": _PRICE, "beds_extra_digit": ["beds_far_above_bedrooms", _RATIOS[2][1]],
         "gps_far_shift": _PLACE, "gps_small_shift": _PLACE}
_ACCEPTED = "CASE a.error_type " + " ".join(f"WHEN '{t}' THEN {m}" for t, m in _MORE.items()) + " ELSE []::VARCHAR[] END"
_CONSISTENT = _DETECT + consistent_chain("") + consistent_chain("2")
ORACLES["consistency_recall"] = with_(_CONSISTENT, f"""
SELECT error_type, injected, detected_fixed, detected, round(100.0::DOUBLE * detected_fixed / injected, 1) AS recall_fixed_pct,
       round(100.0::DOUBLE * detected / injected, 1) AS recall_pct FROM (
  SELECT a.error_type, CAST(count(*) AS BIGINT) AS injected,
    CAST(count_if(list_contains(string_split(j.reject_reason, ','), r.reason)) AS BIGINT) AS detected_fixed,
    CAST(count_if(list_has_any(string_split(j.reject_reason, ','), list_append({_ACCEPTED}, r.reason))) AS BIGINT) AS detected
  FROM assignments a JOIN registry r USING (error_type) LEFT JOIN judged2 j ON j.id = a.id
  WHERE r.detection = 'quarantine' GROUP BY a.error_type)""")
ORACLES["consistency_collateral"] = with_(_CONSISTENT, """
SELECT CAST(count(*) AS BIGINT) AS collateral_rows FROM (
  SELECT DISTINCT id FROM judged2 WHERE reject_reason <> '' AND id IS NOT NULL
  EXCEPT SELECT id FROM assignments
  EXCEPT SELECT id FROM judged WHERE reject_reason <> '' AND id IS NOT NULL)""")


# --- profile state, pairs of missing columns, incremental staging, stateful streams ---------------

def _missing_sql(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


ORACLES["incremental_profile"] = with_([DIRTY], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS rows, CAST(count_if({_missing_sql(c)}) AS BIGINT) AS missing_count, "
    f"round(100.0 * count_if({_missing_sql(c)}) / count(*), 2) AS missing_pct, min({dbl(c)}) AS numeric_min, max({dbl(c)}) AS numeric_max, "
    f"true AS distinct_within, true AS median_within FROM dirty" for c in TEXT_COLS))

_POWER = "greatest(-6, least(12, floor(log10(abs(v)))))"
_NUMBER_BUCKET = (f"CASE WHEN v = 0 THEN 0 ELSE CAST(sign(v) * (({_POWER} + 6) * 9 + greatest(1, least(9, floor(abs(v) / pow(10.0, {_POWER}))))) AS INTEGER) END")
_CELLS = " UNION ALL ".join(
    f"SELECT '{c}' AS col, side, CASE WHEN {_missing_sql(c)} THEN 'missing' WHEN {dbl(c)} IS NOT NULL THEN 'number' ELSE 'text' END AS kind, "
    f"{c} AS s, {dbl(c)} AS v FROM sides" for c in TEXT_COLS)
ORACLES["profile_drift"] = with_([
    DIRTY,
    f"sides AS (SELECT *, CASE WHEN coalesce({dbl('minimum_nights')} <= 14, false) THEN 'a' ELSE 'b' END AS side FROM dirty)",
    f"cells AS ({_CELLS})",
    f"counts AS (SELECT col, kind, CASE kind WHEN 'missing' THEN 0 WHEN 'number' THEN {_NUMBER_BUCKET} "
    "ELSE CAST('0x' || substring(md5(s), 1, 2) AS INTEGER) END AS bucket, "
    "count(*) FILTER (side = 'a') AS a, count(*) FILTER (side = 'b') AS b FROM cells GROUP BY ALL)",
    "shares AS (SELECT *, sum(a) OVER c AS rows_a, sum(b) OVER c AS rows_b, sum(a) OVER k AS of_a, sum(b) OVER k AS of_b, "
    "sum(a) OVER o AS upto_a, sum(b) OVER o AS upto_b, count(*) OVER c AS kinds FROM counts "
    "WINDOW c AS (PARTITION BY col), k AS (PARTITION BY col, kind), o AS (PARTITION BY col, kind ORDER BY bucket))",
    "pq AS (SELECT *, (a + 0.5::DOUBLE) / (rows_a + 0.5::DOUBLE * kinds) AS p, (b + 0.5::DOUBLE) / (rows_b + 0.5::DOUBLE * kinds) AS q FROM shares)",
    "dist AS (SELECT col, CAST(max(rows_a) AS BIGINT) AS rows_a, CAST(max(rows_b) AS BIGINT) AS rows_b, "
    "coalesce(sum(a) FILTER (kind = 'missing'), 0) AS miss_a, coalesce(sum(b) FILTER (kind = 'missing'), 0) AS miss_b, "
    "round(max(abs(upto_a::DOUBLE / of_a - upto_b::DOUBLE / of_b)) FILTER (kind = 'number' AND of_a > 0 AND of_b > 0), 6) AS ks, "
    "round(sum((p - q) * ln(p / q)), 6) AS psi FROM pq GROUP BY col)"],
    "SELECT col AS \"column\", rows_a, rows_b, round(100.0 * miss_a / rows_a, 2)::DOUBLE AS missing_pct_a, round(100.0 * miss_b / rows_b, 2)::DOUBLE AS missing_pct_b, "
    "ks, psi, (psi > 0.2 OR coalesce(ks > 0.1, false)) AS drifted FROM dist")

ORACLES["missing_pairs"] = with_([DIRTY], " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, count_if({_missing_sql(a)} AND {_missing_sql(b)})::BIGINT AS both_missing, "
    f"count_if({_missing_sql(a)} AND NOT {_missing_sql(b)})::BIGINT AS only_a_missing, count_if({_missing_sql(b)} AND NOT {_missing_sql(a)})::BIGINT AS only_b_missing, "
    f"count_if(NOT {_missing_sql(a)} AND NOT {_missing_sql(b)})::BIGINT AS none_missing FROM dirty"
    for i, a in enumerate(TEXT_COLS) for b in TEXT_COLS[i + 1:]))

ORACLES["stage_incremental"] = ORACLES["scan_csv_roundtrip"]
ORACLES["stream_validation"] = with_(BEFORE_CHAIN, suite_sql("minimal", LISTING_SUITE))

_BURSTS = """
WITH base AS (SELECT event_id, ts, CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id, event_type, value FROM events),
e AS (SELECT * FROM base UNION ALL SELECT event_id + 10000000, ts + INTERVAL 5 MINUTES, user_id, event_type, value FROM base WHERE event_id % 10 = 3),
steps AS (SELECT *, coalesce((ts - lag(ts) OVER w >= INTERVAL 6 HOURS)::INT, 1) AS starts FROM e WHERE user_id IS NOT NULL AND event_type IS NOT NULL
  WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
bursts AS (SELECT *, sum(starts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS burst FROM steps),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, burst ORDER BY ts, event_id, value) AS rn FROM bursts)
SELECT event_id, ts, user_id, event_type, value FROM ranked WHERE rn = 1
UNION ALL SELECT event_id, ts, user_id, event_type, value FROM e WHERE user_id IS NULL OR event_type IS NULL"""
ORACLES["dedup_bursts"] = _BURSTS
ORACLES["stream_dedup_bursts"] = _BURSTS
