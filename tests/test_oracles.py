"""A representative set of catalog queries against their DuckDB oracles (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tq.plans.catalog import CATALOG
from tq.sources.tables import TABLES

from conftest import SF_SMALL

KEYS = ["quarantine_reason_counts", "row_rules_reasons", "clean_metrics", "row_reconciliation", "profile_columns",
        "profile_lineitem_columns", "explore_quantiles", "explore_extremes", "explore_format_check",
        "validate_before_after", "validate_summary", "expect_unique_rows", "inject_assignments", "inject_all",
        "detection_recall", "collateral_rows", "validate_documents", "validate_labels", "profile_events_columns",
        "profile_embeddings_columns", "line_item_reason_counts", "stream_row_rules", "inject_other_key",
        "profile_report_csv", "validation_report_json", "pipeline_run", "profile_approx_distinct",
        "explore_quantiles_approx", "seeded_sample_xxhash", "duplicate_rows_count"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def v(x):
        return "NaN" if isinstance(x, float) and math.isnan(x) else x

    return sorted(repr(tuple(v(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert canon(sdf.columns, srows) == canon(dcols, drows)


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(CATALOG) <= set(E.oracle_sql())


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.columns == ["reason", "n"]
    assert out.count() > 0
