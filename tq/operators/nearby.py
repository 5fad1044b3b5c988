"""Rows whose place has few others around it: outliers of the local distribution of two coordinates.

A row is isolated if fewer than ``least`` other rows lie within ``radius`` of it
(straight distance in the units of the coordinates).  The plane is cut into square
cells whose diagonal is the radius, so all rows of one cell are within reach of
each other:

* rows at one place are folded to (place, count) first, so a place that holds a
  third of the table is one row per task;
* a cell with more than ``least`` rows has no isolated row: none of its places is
  compared with anything, however many there are;
* each place of the other cells (at most ``least`` of them per cell) is sent to the
  cells around it that its reach touches, 24 at most, and meets the places there;
  counts are summed in each task before the exchange.

So the pairs grow with the rows, not with the square of a hot cell: each place is
met by at most ``24 * least`` others. A crowded cell next to sparse ones is joined
in parts of its places (``SALTS``), each sparse place is sent to every part.

Rows with a NULL, NaN or infinite coordinate have no place: they are not isolated
and nobody's neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tq.functions.columns import col
from tq.operators.spread import finite

SALTS = 16


def places(df: DataFrame, x: Column, y: Column, radius: float) -> DataFrame:
    """``(x, y, n, cx, cy)``: the places with their rows and their cell."""
    side = radius / math.sqrt(2) * (1 - 1e-9)   # a little under, against rounding
    rows = df.select(x.cast("double").alias("x"), y.cast("double").alias("y")).filter(finite(F.col("x")) & finite(F.col("y")))
    folded = rows.select((F.col("x") + 0.0).alias("x"), (F.col("y") + 0.0).alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    cell = lambda c: F.floor(F.col(c) / F.lit(side))
    return folded.withColumn("cx", cell("x")).withColumn("cy", cell("y"))


def neighbour_counts(df: DataFrame, x: Column, y: Column, radius: float, least: int) -> DataFrame:
    """``(x, y, n, neighbours)`` of the places in cells of at most ``least`` rows: other rows within the radius.

    Places in fuller cells have at least ``least`` neighbours and are not listed.
    """
    if radius <= 0 or least < 1:
        raise ValueError("a radius above 0 and at least one neighbour")
    found = places(df, x, y, radius)
    cells = found.groupBy("cx", "cy").agg(F.sum("n").alias("rows"))
    sparse = found.join(cells.filter(F.col("rows") <= least), ["cx", "cy"], "left_semi")
    reach = F.sequence(F.lit(-2), F.lit(2))
    sent = (sparse.select("x", "y", F.explode(reach).alias("dx"), "cx", "cy")
            .select("x", "y", "cx", "cy", "dx", F.explode(reach).alias("dy"))
            .select("x", "y", (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    others = found.select(F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("n").alias("on"), "cx", "cy",
                          F.pmod(F.xxhash64("x", "y"), F.lit(SALTS)).cast("int").alias("part"))
    dx, dy = F.col("x") - F.col("ox"), F.col("y") - F.col("oy")
    near = sent.join(others, ["cx", "cy", "part"]).filter(dx * dx + dy * dy <= F.lit(float(radius) * float(radius)))
    around = near.groupBy("x", "y").agg(F.sum("on").alias("around"))
    # the place itself is among them
    return sparse.join(around, ["x", "y"]).select("x", "y", "n", (F.col("around") - 1).alias("neighbours"))


def isolated_places(df: DataFrame, x: Column, y: Column, radius: float, least: int) -> DataFrame:
    """``(x, y, n, neighbours)`` of the places whose rows have fewer than ``least`` neighbours."""
    return neighbour_counts(df, x, y, radius, least).filter(F.col("neighbours") < least)


def local_outliers(df: DataFrame, x: str, y: str, radius: float, least: int) -> DataFrame:
    """The rows of ``df`` with fewer than ``least`` other rows within ``radius``, and their ``neighbours``."""
    found = isolated_places(df, col(x), col(y), radius, least)
    found = found.select(F.col("x").alias("__x"), F.col("y").alias("__y"), "neighbours")
    return df.join(found, (col(x) + F.lit(0.0) == F.col("__x")) & (col(y) + F.lit(0.0) == F.col("__y"))).drop("__x", "__y")
