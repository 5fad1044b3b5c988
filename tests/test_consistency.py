"""Rules that compare columns, groups and neighbours; what they add to the detection of injected errors."""

import pytest

from tq.config import CONSISTENT_LISTINGS, LISTINGS, InjectionConfig, Nearby, Ratio, Relation
from tq.operators import consistency
from tq.operators.clean import clean
from tq.operators.inject import error_types
from tq.operators.rules import REASON_TEXT
from tq.plans.experiment import run_consistency_experiment
from tq.sources.tables import dirty

from conftest import SF_MEDIUM


def reasons(result):
    return {r.id: r[REASON_TEXT] for r in result.rejected.collect()}


def test_relation_is_a_row_rule(table):
    rows = table({"id": "1", "beds": "14", "bedrooms": "1"}, {"id": "2", "beds": "14", "bedrooms": "2"}, {"id": "3", "beds": "14", "bedrooms": ""},
                 {"id": "4", "beds": "33", "bedrooms": "1"})
    result = clean(rows, CONSISTENT_LISTINGS)
    assert reasons(result) == {1: "beds_far_above_bedrooms", 4: "beds_too_high,beds_far_above_bedrooms"}
    assert reasons(clean(rows, LISTINGS)) == {4: "beds_too_high"}
    counted = {r.reason: r.n for r in result.reason_counts().collect()}
    assert counted == {"beds_far_above_bedrooms": 2, "beds_too_high": 1}


def test_relations_need_their_columns(table):
    config = LISTINGS.with_(relations=(Relation("no_such", ("beds", "nothing"), "beds > nothing"),))
    assert clean(table({"id": "1"}), config).rejected.count() == 0


CONFIG = LISTINGS.with_(ratios=(Ratio("price", "bedrooms", by=("bedrooms",), least=5), Ratio("beds", by=("bedrooms",), least=5)),
                        nearby=Nearby("latitude", "longitude", 0.01, 3))


def listings(table, *more):
    rows = [{"id": str(i), "price": f"${100 + i % 7}.00", "bedrooms": "2", "beds": str(2 + i % 4), "latitude": f"48.8{i % 3}", "longitude": "2.30"} for i in range(30)]
    return table(*rows, *more)


def test_learned_bounds_and_neighbours(table):
    trusted = clean(listings(table), CONFIG)
    learned = consistency.learn(trusted.clean, CONFIG)
    assert [r.reason for r, _, n in learned.limits] == ["price_per_bedrooms_unusual_for_bedrooms", "beds_unusual_for_bedrooms"]
    assert consistency.judged(trusted, learned).rejected.count() == 0
    other = clean(listings(
        table,
        {"id": "100", "price": "$900.00", "bedrooms": "2", "beds": "3", "latitude": "48.80", "longitude": "2.30"},   # price per bedroom
        {"id": "101", "price": "$103.00", "bedrooms": "2", "beds": "19", "latitude": "48.81", "longitude": "2.30"},  # beds
        {"id": "102", "price": "$103.00", "bedrooms": "2", "beds": "3", "latitude": "48.95", "longitude": "2.55"},   # alone
        {"id": "103", "price": "$900.00", "bedrooms": "3", "beds": "19", "latitude": "48.82", "longitude": "2.30"},  # no bounds for 3 bedrooms
        {"id": "104", "price": "$900.00", "bedrooms": "0", "beds": "3", "latitude": "48.82", "longitude": "2.30"},   # no ratio
        {"id": "105", "price": "", "bedrooms": "2", "beds": "", "latitude": "", "longitude": "2.30"},                # nothing to judge
        {"id": "106", "price": "$900.00", "bedrooms": "2", "beds": "40", "latitude": "40.00", "longitude": "2.30"},  # fixed rules first
    ), CONFIG)
    result = consistency.judged(other, learned)
    assert reasons(result) == {
        100: "price_per_bedrooms_unusual_for_bedrooms", 101: "beds_unusual_for_bedrooms", 102: "coordinates_isolated",
        106: "beds_too_high,coordinates_outside_box,price_per_bedrooms_unusual_for_bedrooms,beds_unusual_for_bedrooms"}
    assert result.clean.columns == other.clean.columns
    assert result.clean.count() + result.rejected.count() == other.reasoned.count()
    assert {r.key: r.value for r in result.metrics().filter("metric = 'quarantine_reasons'").collect()}["coordinates_isolated"] == 1
    learned.release()
    assert learned.scratch.paths == []


def test_saved_result_can_be_judged(table, tmp_path):
    saved = clean(listings(table, {"id": "200", "price": "$5000.00", "bedrooms": "2", "beds": "3", "latitude": "48.80", "longitude": "2.30"}), CONFIG).save(str(tmp_path / "r"))
    result = consistency.judged(saved, consistency.learn(saved.clean, CONFIG))
    assert reasons(result) == {200: "price_per_bedrooms_unusual_for_bedrooms"}


def test_accepted_reasons():
    accepted = consistency.accepted_reasons(error_types(CONSISTENT_LISTINGS), CONSISTENT_LISTINGS)
    assert accepted["beds_extra_digit"] == ["beds_too_high", "beds_far_above_bedrooms", "beds_unusual_for_bedrooms"]
    assert accepted["gps_small_shift"] == ["coordinates_outside_box", "coordinates_isolated"]
    assert accepted["rating_above_5"] == ["review_scores_rating_out_of_range"]
    assert "duplicate_rows" not in accepted and "host_about_phone" not in accepted


def test_more_errors_are_found_without_collateral(spark):
    """The errors that fixed limits miss: prices times 100, one more digit in beds, small shifts of the place."""
    e = run_consistency_experiment(dirty(spark, SF_MEDIUM), CONSISTENT_LISTINGS, InjectionConfig(n=100, seed=42, hash="md5"))
    found = {r.error_type: r for r in e.recall().collect()}
    assert e.collateral().first().collateral_rows == 0
    for name in ("price_x100", "beds_extra_digit", "gps_small_shift"):
        assert found[name].detected > found[name].detected_fixed
    assert found["price_x100"].recall_pct == 100.0 and found["beds_extra_digit"].recall_pct >= 95.0
    assert found["gps_small_shift"].recall_pct > 40 and found["gps_small_shift"].detected_fixed == 0
    for name in ("price_negative", "rating_above_5", "dates_swapped", "gps_far_shift"):
        assert found[name].recall_pct == 100.0
    assert all(r.injected == 100 for r in found.values())
    e.release()
    assert e.learned.scratch.paths == [] and e.fixed.scratch == []


@pytest.mark.parametrize("config", [LISTINGS])
def test_default_rules_are_unchanged(config):
    assert not config.relations and not config.ratios and config.nearby is None
