"""Profile, clean and validate in one Spark application.

The steps are declared as a graph: each names the tables it reads and those it writes.  A run takes any
subset; the order follows from the declaration, and before anything is computed every table that a step
reads must be written by an earlier step of the run or lie in the output folder already.  Folders can be
on any file system that Spark reads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tq.config import LISTINGS, QualityConfig
from tq.operators.clean import QUARANTINED, clean
from tq.operators.expect import validate
from tq.operators.normalize import minimal_typing
from tq.operators.profile import profile
from tq.operators.rules import REASONS
from tq.sources.files import exists, read_partitioned, read_schema, write_json, write_profile_csv, write_schema


@dataclass(frozen=True)
class Step:
    """``work(context)`` reads ``inputs`` and writes ``outputs``, names of folders under the output folder."""

    work: Callable[[Context], None]
    inputs: frozenset[str]
    outputs: tuple[str, ...]


@dataclass
class Context:
    spark: SparkSession
    raw: DataFrame
    folder: str
    config: QualityConfig

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"


def _profile(c: Context) -> None:
    write_profile_csv(profile(c.raw), c.path("profile"))


def _clean(c: Context) -> None:
    saved = clean(c.raw, c.config).save(c.path("reasoned"))
    # the schema is kept beside the table: a table without rows has no file to take it from
    write_schema(c.spark, saved.reasoned.schema, c.path("reasoned_schema"))
    write_json(saved.metrics(), c.path("metrics"))


def _validate(c: Context) -> None:
    schema = read_schema(c.spark, c.path("reasoned_schema"))
    rows = read_partitioned(c.spark, c.path("reasoned"), QUARANTINED, schema)
    after = rows.filter(~F.col(QUARANTINED)).drop(QUARANTINED, REASONS)
    checked = validate(minimal_typing(c.raw, c.config), after, c.config)
    write_json(checked.comparison(), c.path("validation"))
    write_json(checked.summary(), c.path("validation_summary"))
    checked.release()


GRAPH: dict[str, Step] = {
    "profile": Step(_profile, frozenset(), ("profile",)),
    "clean": Step(_clean, frozenset(), ("reasoned", "reasoned_schema", "metrics")),
    "validate": Step(_validate, frozenset({"reasoned", "reasoned_schema"}), ("validation", "validation_summary")),
}


def planned(steps: Iterable[str] | None, available: Callable[[str], bool]) -> list[str]:
    """The steps in graph order.  ``available(name)``: whether an output of an earlier run is there.

    Raises ``KeyError`` for a step the graph does not have, ``FileNotFoundError`` for an input nobody provides.
    """
    wanted = set(GRAPH if steps is None else steps)
    if wanted - set(GRAPH):
        raise KeyError(f"no such step: {sorted(wanted - set(GRAPH))}; the steps are {list(GRAPH)}")
    made: set[str] = set()
    order = [name for name in GRAPH if name in wanted]
    for name in order:
        lacking = sorted(x for x in GRAPH[name].inputs - made if not available(x))
        if lacking:
            raise FileNotFoundError(f"step {name!r} reads {lacking}: add the step that writes it to the run")
        made |= set(GRAPH[name].outputs)
    return order


def run(spark: SparkSession, raw: DataFrame, out_dir: str, steps: Iterable[str] | None = None,
        config: QualityConfig = LISTINGS) -> dict[str, str]:
    """Run the steps on ``raw`` (all-text DataFrame); returns the folder of every output written."""
    context = Context(spark, raw, out_dir, config)
    order = planned(steps, lambda name: exists(spark, context.path(name)))
    for name in order:
        GRAPH[name].work(context)
    return {x: context.path(x) for name in order for x in GRAPH[name].outputs}
