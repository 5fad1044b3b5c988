"""Inject, clean again, measure: the detection experiment as one Spark application."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tq.config import LISTINGS, InjectionConfig, QualityConfig
from tq.operators import consistency, detect
from tq.operators.clean import CleanResult, clean
from tq.operators.inject import assign, corrupt, error_types, usable_types
from tq.session import materialize, scratch_path
from tq.sources.files import remove, write_json


@dataclass
class Experiment:
    baseline: CleanResult
    assignments: DataFrame
    corrupted: DataFrame
    after: CleanResult
    types: list
    config: QualityConfig
    max_assigned: int = 0   # proven bound of the assignments: n x number of types
    scratch: list[str] = field(default_factory=list)   # folders written for this run
    _recall: DataFrame | None = None

    def recall(self) -> DataFrame:
        """One row per error type; measured once (a few rows, checkpointed), then reused."""
        if self._recall is None:
            self._recall = materialize(detect.recall(self.after, self.assignments, self.types, self.config.key,
                                                     self.baseline, self.max_assigned))
        return self._recall

    def overall(self) -> DataFrame:
        return detect.overall(self.recall())

    def collateral(self) -> DataFrame:
        return detect.collateral(self.after, self.assignments, self.baseline, self.config.key, self.max_assigned)

    def write_report(self, folder: str) -> dict[str, str]:
        """Recall per type, overall recall and collateral rows as JSON folders (Spark sinks)."""
        paths = {name: f"{folder.rstrip('/')}/{name}" for name in ("recall", "overall", "collateral")}
        for name, path in paths.items():
            write_json(getattr(self, name)(), path)
        return paths

    def release(self) -> None:
        """Deletes the tables written for this run; only the recall already measured can be read after it."""
        for path in self.scratch:
            remove(self.assignments.sparkSession, path)
        self.scratch = []


@dataclass
class ConsistencyExperiment:
    """The same experiment, judged by the rules that look at other rows too."""

    fixed: Experiment
    after: CleanResult
    baseline: CleanResult
    learned: consistency.Learned

    def recall(self) -> DataFrame:
        """Per error type that leaves a reason: what the fixed rule catches and what all rules together do."""
        e = self.fixed
        return consistency.recall_with(self.after, e.assignments, e.types, e.config, e.max_assigned)

    def collateral(self) -> DataFrame:
        e = self.fixed
        return detect.collateral(self.after, e.assignments, self.baseline, e.config.key, e.max_assigned)

    def release(self) -> None:
        self.learned.release()
        self.fixed.release()


def run_consistency_experiment(raw: DataFrame, config: QualityConfig, cfg: InjectionConfig = InjectionConfig()) -> ConsistencyExperiment:
    """Inject and clean as ``run_experiment`` does; bounds are learned from the clean rows of the uncorrupted table, and both
    tables are judged by them."""
    e = run_experiment(raw, config, cfg)
    learned = consistency.learn(e.baseline.clean, config)
    return ConsistencyExperiment(e, consistency.judged(e.after, learned), consistency.judged(e.baseline, learned), learned)


def run_experiment(raw: DataFrame, config: QualityConfig = LISTINGS, cfg: InjectionConfig = InjectionConfig(),
                   baseline: CleanResult | None = None, checkpoint: bool = True) -> Experiment:
    """Baseline clean -> assignments -> corrupted table -> clean again.

    With ``checkpoint``, the baseline (unless given) and the re-cleaned table are written once to the
    cluster's shared folder and the assignments (bounded: ``n`` per type) are checkpointed, so that the
    counts and joins of the measurement do not clean again.  ``release()`` deletes the tables.
    """
    spark, scratch = raw.sparkSession, []

    def written(result: CleanResult, name: str) -> CleanResult:
        if not checkpoint:
            return result
        scratch.append(scratch_path(spark, f"experiment-{name}-{uuid.uuid4().hex}"))
        return result.save(scratch[-1])

    baseline = baseline or written(clean(raw, config), "before")
    types = usable_types(raw.columns, error_types(config), cfg.types)
    assignments = assign(raw, baseline.clean.select(config.key), config, cfg, types)
    if checkpoint:
        assignments = materialize(assignments)
    corrupted = corrupt(raw, assignments, config, cfg, types)
    after = written(clean(corrupted, config), "after")
    used = {r[0] for r in assignments.select("error_type").distinct().collect()}
    return Experiment(baseline, assignments, corrupted, after, [t for t in types if t.name in used], config,
                      cfg.n * max(1, len(types)), scratch)
