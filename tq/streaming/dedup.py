"""Duplicate keys of a stream: one survivor per burst of repetitions, the same whatever the order of arrival.

Rows of one key that follow each other within ``gap`` of event time are one burst
(a session window of the key); its survivor is the row that is smallest by event
time and then on all other columns. The state holds one row per open burst and is
dropped when the watermark (``delay`` behind the latest event) passes its end;
only then is the survivor emitted, once. Rows later than the watermark are
dropped, as they could change what has been emitted.

The same columns describe a batch: ``survivors`` of a whole table equals what the
stream emits for the same rows, if none comes later than ``delay`` and the
watermark has passed the last burst. Rows without a key are never merged and pass
at once; rows without an event time have no burst and are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tq.functions.columns import col


def survivors(df: DataFrame, keys, time: str, gap: str, delay: str | None = None) -> DataFrame:
    """One row per burst, all columns of ``df``; for a stream, ``delay`` is its watermark."""
    keys, columns = list(keys), df.columns
    order = [time, *[c for c in columns if c not in (time, *keys)]]
    keyed = df
    if delay is not None:
        keyed = keyed.withWatermark(time, delay)
    known = None
    for k in keys:
        known = col(k).isNotNull() if known is None else known & col(k).isNotNull()
    packed = F.struct(*[col(c).alias(f"f{i}") for i, c in enumerate(order)])
    # the least of each burst is kept in every task before the exchange
    bursts = keyed.filter(known & col(time).isNotNull()).groupBy(F.session_window(col(time), gap), *[col(k) for k in keys]).agg(F.min(packed).alias("__row"))
    fields = {c: F.col(f"__row.f{i}").alias(c) for i, c in enumerate(order)}
    merged = bursts.select(*[col(c) if c in keys else fields[c] for c in columns])
    return merged.unionByName(keyed.filter(~known).select(*[col(c) for c in columns]))


def start_dedup_stream(stream: DataFrame, path: str, checkpoint: str, keys, time: str, gap: str, delay: str,
                       available_now: bool = False) -> StreamingQuery:
    """Writes the survivors to Parquet under ``path``; offsets and state in ``checkpoint`` (shared storage) make it go on
    after a restart without losing or repeating a row."""
    writer = (survivors(stream, keys, time, gap, delay).writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .outputMode("append"))
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)
