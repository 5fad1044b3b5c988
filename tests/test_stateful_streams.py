"""Streams with state: late and repeated rows over restarts, batches that are tried again, files taken once."""

import glob
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tq.config import LISTINGS
from tq.operators.expect import build_rules, evaluate
from tq.operators.normalize import minimal_typing
from tq.sources.files import stage_new, write_raw_csv
from tq.sources.tables import dirty
from tq.streaming.dedup import start_dedup_stream, survivors
from tq.streaming.validation import compact, running_result, start_validation_stream, write_batch

from conftest import SF_SMALL

START = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp, v int"


def at(hours):
    return START + timedelta(hours=hours)


def test_bursts_over_restarts_equal_the_batch(spark, tmp_path):
    """Each delivery is a run of the stream of its own; rows come late and repeated, within the delay."""
    deliveries = [
        [("a", at(0), 5), ("a", at(0.5), 1), ("b", at(1), 2), (None, at(1), 9), ("c", at(4), 1)],
        [("a", at(0.2), 7), ("b", at(1), 1), ("b", at(1), 1), (None, at(1), 9), ("c", at(4), 1)],
        [("a", at(9), 3), ("b", at(9.5), 4), ("c", at(4.9), 0), ("a", None, 1)],
        [("z", at(100), 0)],
    ]
    landing, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "log"))
    for rows in deliveries:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        start_dedup_stream(stream, out, checkpoint, ["k"], "ts", "1 hour", "6 hours", available_now=True).awaitTermination()
    got = sorted(map(tuple, spark.read.schema(SCHEMA).parquet(out).collect()), key=str)
    whole = spark.createDataFrame([r for rows in deliveries for r in rows if r[0] != "z"], SCHEMA)
    batch = sorted(map(tuple, survivors(whole, ["k"], "ts", "1 hour").collect()), key=str)
    assert got == batch == sorted([("a", at(0), 5), ("a", at(9), 3), ("b", at(1), 1), ("b", at(9.5), 4), ("c", at(4), 1), (None, at(1), 9), (None, at(1), 9)], key=str)
    # a row behind the watermark cannot change what was emitted
    spark.createDataFrame([("a", at(0.1), 0)], SCHEMA).write.mode("append").parquet(landing)
    start_dedup_stream(spark.readStream.schema(SCHEMA).parquet(landing), out, checkpoint, ["k"], "ts", "1 hour", "6 hours", available_now=True).awaitTermination()
    assert sorted(map(tuple, spark.read.schema(SCHEMA).parquet(out).collect()), key=str) == got


def test_running_suite_equals_the_whole(spark, tmp_path):
    d = dirty(spark, SF_SMALL)
    landing, path = str(tmp_path / "in"), str(tmp_path / "suite")
    d.repartition(4).write.parquet(landing)
    typed = minimal_typing(spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 2).parquet(landing), LISTINGS)
    rules = build_rules(typed.columns, LISTINGS)
    assert all(r.checked_rows == 0 for r in running_result(spark, path, rules).collect())
    start_validation_stream(typed, rules, path, str(tmp_path / "log"), available_now=True).awaitTermination()
    want = sorted(map(tuple, evaluate(minimal_typing(d, LISTINGS), rules).collect()))
    assert sorted(map(tuple, running_result(spark, path, rules).collect())) == want
    assert len(glob.glob(f"{path}/counts/batch=*")) == 2
    # a batch that is tried again replaces itself
    files = sorted(glob.glob(f"{landing}/*.parquet"))
    first = minimal_typing(spark.read.schema(d.schema).parquet(*files[:1]), LISTINGS)
    other = str(tmp_path / "again")
    for _ in range(2):
        write_batch(first, rules, other, 0)
    write_batch(minimal_typing(spark.read.schema(d.schema).parquet(*files[1:]), LISTINGS), rules, other, 1)
    assert sorted(map(tuple, running_result(spark, other, rules).collect())) == want
    compact(spark, other, rules)
    assert [os.path.basename(x) for x in glob.glob(f"{other}/*/batch=*")] == ["batch=1"] * 2
    assert sorted(map(tuple, running_result(spark, other, rules).collect())) == want


def test_files_are_staged_once(spark, tmp_path):
    folder, to, log = (str(tmp_path / x) for x in ("csv", "staged", "log"))
    rows = [(str(i), f'said "no"\nline {i}') for i in range(40)]

    def deliver(part):
        write_raw_csv(spark.createDataFrame(part, "id string, note string").coalesce(2), folder, mode="append")
        return stage_new(spark, folder, to, log, ["id", "note"], files_per_batch=1)

    assert deliver(rows[:15]).count() == 15
    before = set(glob.glob(f"{to}/*.parquet"))
    staged = deliver(rows[15:])
    assert sorted(map(tuple, staged.collect())) == sorted(rows)
    assert before < set(glob.glob(f"{to}/*.parquet"))   # nothing of the first delivery was written again
    # a run that broke off after its files were written, before its batch was noted as done
    commits = sorted(glob.glob(f"{log}/commits/[0-9]*"), key=lambda x: int(os.path.basename(x)))
    os.remove(commits[-1])
    for crc in glob.glob(f"{log}/commits/.{os.path.basename(commits[-1])}.crc"):
        os.remove(crc)
    again = stage_new(spark, folder, to, log, ["id", "note"])
    assert sorted(map(tuple, again.collect())) == sorted(rows)
    assert again.filter(F.col("id").isNull()).count() == 0
