"""Small DataFrame combinators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row aggregates into one row.

    The frames are unioned (each padded with NULL columns) and folded by a
    global ``max``, so no join is planned; every input is a one-row aggregate.
    """
    schemas = [f.schema.fields for f in frames]          # one schema round trip per frame
    names = [fld.name for fields in schemas for fld in fields]
    if len(names) != len(set(names)):
        raise ValueError(f"duplicate column names: {names}")
    types = {fld.name: fld.dataType for fields in schemas for fld in fields}
    padded = []
    for f, fields in zip(frames, schemas):
        own = {fld.name for fld in fields}
        padded.append(f.select([F.col(c) if c in own else F.lit(None).cast(types[c]).alias(c) for c in names]))
    return reduce(DataFrame.unionByName, padded).agg(*[F.max(c).alias(c) for c in names])


# A broadcast side is copied to every executor: only hint it when its row count has a proven bound
# (a parameter or the configuration, never the data) below this limit; above it Spark plans a shuffle join.
MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` when ``max_rows`` (a proven upper bound of its rows) is small enough, else ``df``."""
    return F.broadcast(df) if max_rows <= MAX_BROADCAST_ROWS else df


def hashed_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (``rows`` rows, counted) as the hashed side of a join: broadcast when small enough, else shuffled. The rows of
    the other side are not sorted either way."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df.hint("shuffle_hash")
