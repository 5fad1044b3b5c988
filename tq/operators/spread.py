"""Exact median and median absolute deviation of many groups at once, and the rows far from their group.

``percentile`` and ``median`` buffer every value of a group in one task.  Here no
group is ever gathered: the rows are folded to (group, value, count) once, an
aggregate combined map-side and spread over the values, so a group that holds a
third of the table is spread too.  Groups of at most ``SMALL`` different values are
ranked by windows, dealt by group: one shuffle for both statistics of all of them.
In the larger groups every wanted rank has a bracket [low, high], and each round cuts all open brackets into ``BUCKETS`` buckets
(a grouped aggregate with count, minimum and maximum per bucket) and goes on with
the bucket that holds the rank, until its minimum equals its maximum.  A bracket
always loses its lowest or its highest value, so the rounds end; real data needs
two or three, for all groups together.

The large groups are fewer than one in ``SMALL`` rows, so their brackets (one row per
group and rank) are few too: they are broadcast while they are (counted); beyond that they are joined by group and a part of the values, so that
a large group is split over ``SALTS`` tasks.

NULL is a group like any other. NULL, NaN and infinite values are in no statistic
and are never far.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tq.functions import frames
from tq.functions.columns import col
from tq.session import scratch_path
from tq.sources.files import remove

BUCKETS, SALTS = 256, 32
#: Different values of the largest group that one task may rank.
SMALL = 4096


class Scratch:
    """Intermediate tables in the shared folder, deleted together when the last result has been written."""

    def __init__(self, spark, name: str):
        self.spark, self.name, self.paths = spark, name, []

    def write(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark, f"{self.name}-{uuid.uuid4().hex}"))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def release(self) -> None:
        for path in self.paths:
            remove(self.spark, path)
        self.paths = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.release()


def _groups(by) -> list[str]:
    return [f"g{i}" for i in range(len(by))]


def _same(left: str, right: str, names) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}")) for g in names], F.lit(True))


def finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(math.inf))


def frequencies(df: DataFrame, by, value: Column) -> DataFrame:
    """``(g0.., v, n, salt)``: the finite values of each group with their counts."""
    rows = df.select(*[col(c).alias(g) for c, g in zip(by, _groups(by))], value.cast("double").alias("v")).filter(finite(F.col("v")))
    # -0.0 and 0.0 are one value
    folded = rows.withColumn("v", F.col("v") + F.lit(0.0)).groupBy(*_groups(by), "v").agg(F.count(F.lit(1)).alias("n"))
    return folded.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))


def with_groups(freq: DataFrame, state: DataFrame, names, size: int) -> DataFrame:
    """``freq`` joined with the columns of ``state`` (``size`` rows, by group): broadcast while it is small, else a
    shuffle join in which every group is split by its values."""
    kept = [c for c in state.columns if c not in names]
    if size <= frames.MAX_BROADCAST_ROWS:
        joined = freq.alias("f").join(F.broadcast(state.alias("s")), _same("f", "s", names))
    else:
        dealt = state.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = freq.alias("f").join(dealt.alias("s"), _same("f", "s", [*names, "salt"]))
    return joined.select("f.*", *[F.col(f"s.{c}") for c in kept])


def _axis(v: Column) -> Column:
    return F.signum(v) * F.log1p(F.abs(v))


def bucket_of(v: Column, low: Column, high: Column) -> Column:
    """Number of the bucket of ``v`` in [low, high]: on a log axis, on a linear one where that collapses."""
    a, b = _axis(low), _axis(high)
    share = F.when(b > a, (_axis(v) - a) / (b - a)).otherwise((v / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0)))
    return F.greatest(F.lit(0), F.least(F.lit(BUCKETS - 1), F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS).cast("int")))


def at_ranks(freq: DataFrame, ranks: DataFrame, names, size: int, scratch: Scratch) -> DataFrame:
    """``(g0.., rank, value)``: the value of each wanted rank (from 0) of each group.

    ``ranks``: ``(g0.., rank, low, high)`` with the group's range; ``size``: its rows.
    """
    state = scratch.write(ranks.withColumn("below", F.lit(0).cast("bigint")))
    done = []
    order = Window.partitionBy(*names, "rank").orderBy("bucket")
    while True:
        done.append(state.filter("low = high").select(*names, "rank", F.col("low").alias("value")))
        state = state.filter("low <> high")
        if state.isEmpty():
            return reduce(DataFrame.unionByName, done)
        inside = with_groups(freq, state, names, size).filter("v between low and high")
        buckets = inside.withColumn("bucket", bucket_of(F.col("v"), F.col("low"), F.col("high"))).groupBy(*names, "rank", "below", "bucket").agg(
            F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        # at most BUCKETS rows per group and rank
        upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("below")
        held = buckets.withColumn("upto", upto).filter("rank < upto and rank >= upto - n")
        state = scratch.write(held.select(*names, "rank", "low", "high", (F.col("upto") - F.col("n")).alias("below")))


def middles(freq: DataFrame, names, scratch: Scratch) -> tuple[DataFrame, int]:
    """``(g0.., n, median)`` of each group, and the number of groups."""
    sizes = scratch.write(freq.groupBy(*names).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
    groups = sizes.count()
    wanted = F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))
    ranks = sizes.select(*names, F.explode(wanted).alias("rank"), "low", "high")
    values = at_ranks(freq, ranks, names, 2 * groups, scratch).groupBy(*names).agg(F.min("value").alias("a"), F.max("value").alias("b"))
    both = sizes.alias("f").join(values.alias("s"), _same("f", "s", names))
    median = F.col("a") + (F.col("b") - F.col("a")) * 0.5
    return scratch.write(both.select(*[F.col(f"f.{g}") for g in names], "n", median.alias("median"))), groups


def divided(freq: DataFrame, names, scratch: Scratch) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of ``freq`` of the groups of at most ``SMALL`` different values, and those of the larger groups (None: no such group)."""
    large = scratch.write(freq.groupBy(*names).agg(F.count(F.lit(1)).alias("d")).filter(F.col("d") > SMALL))
    count = large.count()
    if not count:
        return freq, None
    if not names:
        return None, freq
    side = frames.bounded_broadcast(large, count).alias("s")
    return tuple(freq.alias("f").join(side, _same("f", "s", names), how) for how in ("left_anti", "left_semi"))


def small_spread(freq: DataFrame, names) -> DataFrame:
    """``(g0.., n, median, mad)`` of groups that one task may rank: dealt by group once, sorted by value and by deviation."""
    group = Window.partitionBy(*names)

    def holds(rank: Column) -> Column:
        return (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n"))

    def counted(rows: DataFrame, v: str) -> DataFrame:
        upto = F.sum("n").over(group.orderBy(v).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return rows.withColumn("upto", upto)

    def middle(v: str) -> tuple[Column, Column]:
        return (F.min(F.when(holds(F.floor((F.col("total") - 1) / 2)), F.col(v))),
                F.max(F.when(holds(F.floor(F.col("total") / 2)), F.col(v))))

    rows = counted(freq, "v").withColumn("total", F.sum("n").over(group))
    a, b = middle("v")
    rows = rows.withColumn("a", a.over(group)).withColumn("b", b.over(group))
    rows = rows.withColumn("median", F.col("a") + (F.col("b") - F.col("a")) * 0.5).withColumn("away", F.abs(F.col("v") - F.col("median")))
    a, b = middle("away")
    out = counted(rows, "away").groupBy(*names).agg(F.max("total").alias("n"), F.max("median").alias("median"), a.alias("a"), b.alias("b"))
    return out.select(*names, "n", "median", (F.col("a") + (F.col("b") - F.col("a")) * 0.5).alias("mad"))


def large_spread(freq: DataFrame, names, scratch: Scratch) -> DataFrame:
    """``(g0.., n, median, mad)`` of groups of any size, none of which is gathered."""
    center, groups = middles(freq, names, scratch)
    away = with_groups(freq, center.select(*names, "median"), names, groups)
    away = away.select(*names, F.abs(F.col("v") - F.col("median")).alias("v"), "n").groupBy(*names, "v").agg(F.sum("n").alias("n"))
    away = scratch.write(away.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")))
    mad, _ = middles(away, names, scratch)
    both = center.alias("f").join(mad.alias("s"), _same("f", "s", names))
    return both.select(*[F.col(f"f.{g}") for g in names], F.col("f.n").alias("n"), F.col("f.median").alias("median"), F.col("s.median").alias("mad"))


def group_spread(df: DataFrame, by, value: Column | str, scratch: Scratch | None = None) -> DataFrame:
    """``(by.., n, median, mad)``: count, median and median absolute deviation of the finite values of each group.

    The result is a written table; with ``scratch`` it goes when that is released, together with the others.
    """
    by, value = list(by), col(value) if isinstance(value, str) else value
    own = Scratch(df.sparkSession, "spread")
    keep = scratch or Scratch(df.sparkSession, "spread")
    names = _groups(by)
    with own:
        freq = own.write(frequencies(df, by, value))
        few, many = divided(freq, names, own)
        parts = [] if few is None else [small_spread(few, names)]
        parts += [] if many is None else [large_spread(own.write(many), names, own)]
        both = reduce(DataFrame.unionByName, parts)
        return keep.write(both.select(*[F.col(g).alias(c) for g, c in zip(names, by)], "n", "median", "mad"))


def bounds(spread: DataFrame, cutoff: float, least: int) -> DataFrame:
    """``(by.., low, high)``: median -/+ ``cutoff`` deviations of the groups that have ``least`` values and a deviation."""
    by = [c for c in spread.columns if c not in ("n", "median", "mad")]
    usable = spread.filter((F.col("n") >= least) & (F.col("mad") > 0))
    return usable.select(*[col(c) for c in by], (F.col("median") - F.lit(float(cutoff)) * F.col("mad")).alias("low"),
                         (F.col("median") + F.lit(float(cutoff)) * F.col("mad")).alias("high"))


def outside_bounds(df: DataFrame, limits: DataFrame, by, value: Column, flag: str, groups: int | None = None) -> DataFrame:
    """``df`` with a boolean column ``flag``: the finite value lies outside the bounds of its group (false without bounds)."""
    by, columns = list(by), df.columns
    groups = limits.count() if groups is None else groups
    side = limits.select(*[col(c).alias(f"__g{i}") for i, c in enumerate(by)], F.col("low").alias("__low"), F.col("high").alias("__high"))
    side = frames.bounded_broadcast(side, groups)
    named = df.withColumn("__value", value.cast("double"))
    # rows without a value need no bounds: their group does not matter, so they do not meet in one task
    same = reduce(lambda a, b: a & b, [col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(by)], finite(F.col("__value")))
    far = (F.col("__value") < F.col("__low")) | (F.col("__value") > F.col("__high"))
    return named.join(side, same, "left").select(*[col(c) for c in columns], F.coalesce(far, F.lit(False)).alias(flag))


def group_outliers(df: DataFrame, by, value: str, cutoff: float = 4.0, least: int = 20, scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``df`` whose ``value`` is more than ``cutoff`` median absolute deviations from its group's median."""
    limits = bounds(group_spread(df, by, value, scratch), cutoff, least)
    return outside_bounds(df, limits, by, col(value), "__far").filter("__far").drop("__far")
