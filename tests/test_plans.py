"""Physical-plan shapes that the design relies on at scale."""

import contextlib
import io
import re

from tq.config import LISTINGS, InjectionConfig
from tq.functions import frames
from tq.operators import explore as X
from tq.operators.clean import clean
from tq.operators.dedup import dedup_by_key
from tq.operators.inject import corrupt, eligibility, error_types, usable_types
from tq.operators.profile import profile
from tq.plans.experiment import run_experiment
from tq.sources.tables import dirty

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_dedup_sorts_no_row_of_an_unrepeated_key(spark):
    """The survivor aggregate (which sorts) stands only above the semi join with the repeated keys."""
    p = plan(dedup_by_key(dirty(spark, SF_SMALL), "id"))
    assert "Window" not in p
    branches = re.split(r"\n(?=   [:+]- )", p)
    single = [b for b in branches if "LeftAnti" in b]
    assert len(single) == 1 and "SortAggregate" not in single[0]
    assert all("LeftSemi" in b for b in branches if "SortAggregate" in b)


def test_dedup_sorts_no_row_when_broadcasts_are_not_chosen_by_spark(spark, monkeypatch):
    """A table too large for Spark to guess that few keys repeat: they are counted, and hashed where there are many."""
    rows = [(str(i if i % 5 else i // 10), i) for i in range(60)] + [(None, 1), (None, 1)]
    df, joins = spark.createDataFrame(rows, "id string, v int"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = []
        for most in (2_000_000, 0):
            monkeypatch.setattr(frames, "MAX_BROADCAST_ROWS", most)
            out = dedup_by_key(df, "id")
            joins.append(plan(out))
            found.append(sorted(map(tuple, out.collect()), key=str))
        e = plan(eligibility(df, df.select("id"), "id", [t for t in error_types(LISTINGS) if t.name == "duplicate_rows"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in joins[0] + joins[1] + e
    assert "BroadcastHashJoin" in joins[0] and "ShuffledHashJoin" in joins[1]
    smallest = {k: min(v for x, v in rows if x == k) for k, _ in rows if k}
    assert found[0] == found[1] == sorted([*smallest.items(), (None, 1), (None, 1)], key=str)


def test_profile_is_one_aggregate(spark):
    p = plan(profile(dirty(spark, SF_SMALL)))
    exchanges = [line for line in p.splitlines() if "Exchange" in line and "SinglePartition" in line]
    assert len(exchanges) == 1
    assert "hashpartitioning" not in p


def test_corruption_broadcasts_the_bounded_assignments(spark):
    raw = dirty(spark, SF_SMALL)
    types = usable_types(raw.columns, error_types(LISTINGS))
    a = spark.createDataFrame([(1, "1", "price_x100")], "id bigint, key_text string, error_type string")
    p = plan(corrupt(raw, a, LISTINGS, InjectionConfig(n=5), types))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_eligibility_aggregates_before_joining(spark):
    raw = dirty(spark, SF_SMALL)
    types = usable_types(raw.columns, error_types(LISTINGS))
    p = plan(eligibility(raw, clean(raw, LISTINGS).clean.select("id"), "id", types))
    join_at = p.index("Join")
    assert "partial_max" in p[join_at:]      # the per-key fold sits below the join


def test_detection_has_no_nested_loop_or_cartesian_join(spark):
    e = run_experiment(dirty(spark, SF_SMALL), LISTINGS, InjectionConfig(n=5, seed=1))
    for df in (e.recall(), e.overall(), e.collateral()):
        p = plan(df)
        assert "NestedLoop" not in p and "Cartesian" not in p


def test_top_k_per_group_is_limited_before_the_shuffle(spark):
    p = plan(X.extremes(dirty(spark, SF_SMALL), ["beds"], "id", exact=False))
    assert p.count("WindowGroupLimit") >= 2


def test_saved_outputs_prune_partitions(spark, tmp_path):
    saved = clean(dirty(spark, SF_SMALL), LISTINGS).save(str(tmp_path / "r"))
    assert "PartitionFilters: [isnotnull(quarantined" in plan(saved.clean)
