"""The step graph, and a run of it on a URI."""

import itertools

import pytest

from tq.plans.steps import GRAPH, planned, run
from tq.sources.files import exists, stage_raw, write_raw_csv
from tq.sources.tables import dirty

from conftest import SF_SMALL


def subsets():
    return [s for n in range(len(GRAPH) + 1) for s in itertools.permutations(GRAPH, n)]


def test_every_subset_is_ordered_and_has_its_inputs():
    everything = {x for s in GRAPH.values() for x in s.outputs}
    for steps in subsets():
        assert planned(steps, everything.__contains__) == [x for x in GRAPH if x in steps]
        made = {x for s in steps for x in GRAPH[s].outputs}
        if all(GRAPH[s].inputs <= made for s in steps):
            assert planned(steps, lambda _: False) == [x for x in GRAPH if x in steps]
        else:
            with pytest.raises(FileNotFoundError):
                planned(steps, lambda _: False)
    assert planned(None, lambda _: False) == list(GRAPH)


def test_steps_outside_the_graph_are_refused():
    with pytest.raises(KeyError, match="archive"):
        planned(["clean", "archive"], lambda _: True)


def test_run_in_two_parts_on_a_uri(spark, tmp_path):
    """Steps of separate runs find each other's outputs in a folder given as a URI."""
    folder, raw = f"file://{tmp_path}/out", dirty(spark, SF_SMALL)
    with pytest.raises(FileNotFoundError):
        run(spark, raw, folder, steps=["validate"])
    first = run(spark, raw, folder, steps=["clean", "profile"])
    second = run(spark, raw, folder, steps=["validate"])
    assert set(first) | set(second) == {x for s in GRAPH.values() for x in s.outputs}
    assert all(exists(spark, path) for path in [*first.values(), *second.values()])
    assert spark.read.json(second["validation_summary"]).count() == 2


def test_run_on_a_table_without_rows(spark, tmp_path):
    out = run(spark, dirty(spark, SF_SMALL).where("false"), str(tmp_path / "none"))
    rows = {r["side"]: r["rows"] for r in spark.read.json(out["validation_summary"]).collect()}
    assert rows == {"before": 0, "after": 0}


def test_many_raw_files_are_staged_as_they_are_read(spark, table, tmp_path):
    """Few files are spread over more; as many as asked for or more are not dealt anew, and keep every row."""
    raw = table(*[{"id": str(i)} for i in range(60)])
    for files, staged_files in ((1, 4), (6, 6)):
        csv, staged = str(tmp_path / f"csv{files}"), str(tmp_path / f"staged{files}")
        write_raw_csv(raw.repartition(files), csv)
        spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))  # a task for each small file
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
        try:
            rows = stage_raw(spark, csv, staged, partitions=4)
            assert sorted(x.id for x in rows.collect()) == sorted(str(i) for i in range(60))
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(list((tmp_path / f"staged{files}").glob("part-*.parquet"))) == staged_files
