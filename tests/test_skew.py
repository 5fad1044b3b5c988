"""Correctness when one key, or one group of identical copies, holds a third of the rows."""

import random

from pyspark.sql import functions as F

from tq.config import LISTINGS
from tq.operators.clean import clean
from tq.operators.dedup import dedup_by_key
from tq.operators.expect import Unique, evaluate, unexpected_rows


def test_hot_key_survivor_is_the_global_minimum(spark):
    rnd = random.Random(5)
    rows = [(7 if i % 3 == 0 else i, rnd.randint(0, 10 ** 6), rnd.choice(["a", "b", None])) for i in range(30000)]
    df = spark.createDataFrame(rows, "k bigint, v bigint, t string").repartition(16)
    out = {r["k"]: r for r in dedup_by_key(df, "k").collect()}
    hot = [(v, t) for k, v, t in rows if k == 7]
    want = min(hot, key=lambda x: (x[0], "" if x[1] is None else "\x01" + x[1]))   # NULL sorts first
    assert (out[7]["v"], out[7]["t"]) == want
    assert len(out) == len({k for k, _, _ in rows})


def test_identical_null_key_copies_are_all_kept(spark):
    copies = [(None, "same", "row")] * 9000 + [(str(i), "x", "y") for i in range(18000)]
    df = spark.createDataFrame(copies, "id string, a string, b string").repartition(8)
    r = clean(df, LISTINGS)
    log = r.log()
    assert log["rows_quarantined"] == 9000 and log["rows_clean"] == 18000
    assert log["duplicate_keys_removed"] == 0


def test_hot_value_uniqueness(spark):
    df = spark.createDataFrame([(-1 if i % 3 == 0 else i,) for i in range(9000)], "k bigint").repartition(8)
    res = evaluate(df, [("k unique", Unique("k"))]).collect()[0]
    assert res["unexpected_count"] == 3000
    assert unexpected_rows(df, Unique("k")).filter(F.col("k") == -1).count() == 3000
