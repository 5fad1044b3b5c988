"""Benchmark of the headline jobs; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

The headline metric is the published end-to-end job — profile, then clean +
quarantine (written once as Parquet), then validate before/after — on the
dirty listing table derived from ``orders`` x ``customer``.  Other jobs are
timed separately.  Every timed job ends in an action that consumes the whole
result (a write, or a collect of a small result).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pyspark.sql import SparkSession
    from pyspark.sql.functions import col

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tq-bench")
        .config("spark.sql.shuffle.partitions", str(max(2, cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # call-site capture for error messages costs several Py4J round trips per Column call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="tq-bench-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    from tq.config import LISTINGS, InjectionConfig
    from tq.operators import explore as X
    from tq.functions.columns import parse_currency
    from tq.operators.clean import clean
    from tq.operators.dedup import dedup_by_key
    from tq.operators.expect import validate
    from tq.operators.normalize import minimal_typing
    from tq.operators.profile import profile, table_summary
    from tq.operators.quantiles import approx_quantiles, exact_quantiles
    from tq.plans.experiment import run_experiment
    from tq.sources.files import stage_raw, write_json, write_profile_csv, write_raw_csv
    from tq.sources.tables import dirty, read_table

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # one raw gzip CSV, staged once (parsed by one task, spread over files): later steps read Parquet
    csv_path = os.path.join(scratch, "raw-csv")
    write_raw_csv(dirty(spark, sf_dir).coalesce(1), csv_path)
    raw = timed("stage_csv", lambda: stage_raw(spark, csv_path, os.path.join(scratch, "raw"), partitions=cpus * 2))
    rows = raw.count()
    cells = rows * len(raw.columns)

    # headline: profile -> clean -> validate
    def profile_step(raw, to):
        write_profile_csv(profile(raw), f"{to}/profile")
        return table_summary(raw, key="id").collect()

    def clean_step(raw, to):
        saved = clean(raw, LISTINGS).save(f"{to}/reasoned")
        write_json(saved.metrics(), f"{to}/metrics")
        return saved

    def validate_step(raw, saved, to):
        checked = validate(minimal_typing(raw, LISTINGS), saved.clean, LISTINGS)
        write_json(checked.comparison(), f"{to}/validation")
        out = checked.summary().collect()
        checked.release()
        return out

    timed("profile", lambda: profile_step(raw, f"{scratch}/out"))
    saved = timed("clean", lambda: clean_step(raw, f"{scratch}/out"))
    timed("validate", lambda: validate_step(raw, saved, f"{scratch}/out"))

    # the same three steps on 90 columns: further copies of the text columns under other names
    names = [c for c in raw.columns if c != "id"]
    more = [col(names[i % len(names)]).alias(f"{names[i % len(names)]}_{i // len(names)}_copy") for i in range(90 - len(raw.columns))]
    wide_path = os.path.join(scratch, "wide")
    raw.select("*", *more).write.parquet(wide_path)
    wide = spark.read.parquet(wide_path)

    def wide_steps():
        profile_step(wide, f"{scratch}/wide-out")
        validate_step(wide, clean_step(wide, f"{scratch}/wide-out"), f"{scratch}/wide-out")

    timed("wide_90_columns", wide_steps)
    end_to_end = round(times["profile"] + times["clean"] + times["validate"], 3)

    # exploration: all checks of the explore step
    def explore_step():
        out = [X.format_check(raw, "price", X.PRICE_FORMAT).collect(),
               X.non_positive(raw, "price").collect(),
               approx_quantiles(raw.select(parse_currency("price").alias("p")), "p", X.PRICE_PROBS).collect(),
               X.top_values(raw, parse_currency("price"), "id").collect(),
               X.extremes(raw, ["beds", "minimum_nights"], "id", exact=False).collect(),
               X.score_ranges(raw, ["review_scores_rating"]).collect(),
               X.date_order(raw, "first_review", "last_review").collect(),
               X.outside_box(raw, LISTINGS.box).collect(),
               X.numeric_text(raw, "host_about", LISTINGS.digit_only_pattern).collect()]
        return out

    timed("explore", explore_step)

    # injection experiment (n = 500 per type, seed 42), reusing the saved baseline
    def inject_step():
        e = run_experiment(raw, LISTINGS, InjectionConfig(n=500, seed=42), baseline=saved)
        return e.recall().collect(), e.collateral().collect()

    timed("inject_detect", inject_step)

    # profile of a typed driver table (the largest one)
    lineitem = read_table(spark, sf_dir, "lineitem").repartition(cpus)
    timed("profile_lineitem", lambda: profile(lineitem).collect())

    # exact paths, and dedup where a third of the keys repeat
    timed("exact_quantiles", lambda: exact_quantiles(lineitem, "l_extendedprice", X.PRICE_PROBS).collect())
    timed("exact_distinct", lambda: profile(lineitem, approx=False, exact_distinct=True).collect())
    repeated = raw.unionByName(raw.filter(col("id").rlike("[0-2]$")))
    timed("dedup_repeated_keys", lambda: dedup_by_key(repeated, "id").write.format("noop").mode("overwrite").save())

    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "profile_clean_validate_sec",
        "value": end_to_end,
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "rows_per_sec": round(rows / end_to_end, 1) if end_to_end else None,
        "cells_per_sec": round(cells / end_to_end, 1) if end_to_end else None,
        "wide_cells_per_sec": round(rows * 90 / times["wide_90_columns"], 1) if times["wide_90_columns"] else None,
        "sf": float(sf_match.group(1)) if sf_match else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
