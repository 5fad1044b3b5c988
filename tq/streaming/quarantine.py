"""Row rules on a stream (Structured Streaming).

Normalisation, typing, repairs and row rules are stateless projections, so the
batch columns apply unchanged to a streaming DataFrame; each micro-batch is
split into clean and quarantined rows by one partitioned file sink.

Two batch steps need state or a full pass and are not applied to streams:
dropping fully empty columns (the schema of a stream is fixed, so the column
list comes from the declared schema) and key deduplication (it needs an event
time and a watermark; a text table has neither).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tq.config import LISTINGS, QualityConfig
from tq.operators.normalize import normalize, typed_projection
from tq.operators.rules import REASON_TEXT, REASONS, reason_text, reasons_column, row_rules

QUARANTINED = "quarantined"


def reasoned_stream(stream: DataFrame, config: QualityConfig = LISTINGS) -> DataFrame:
    """Typed, repaired rows with ``reject_reason`` and the ``quarantined`` flag (works for batch too)."""
    typed = typed_projection(normalize(stream), config, repair=True)
    reasons = reasons_column(row_rules(config, typed.columns))
    return (typed.withColumn(REASONS, reasons)
            .withColumn(REASON_TEXT, reason_text(REASONS))
            .withColumn(QUARANTINED, F.size(REASONS) > 0)
            .drop(REASONS))


def start_quarantine_stream(stream: DataFrame, path: str, checkpoint: str, config: QualityConfig = LISTINGS,
                            available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Continuously write reasoned rows to Parquet under ``path``, partitioned by ``quarantined``.

    ``checkpoint`` must be on shared storage: it holds the offsets that make
    the file sink exactly-once across restarts and executor loss.
    """
    writer = (reasoned_stream(stream, config).writeStream.format("parquet")
              .option("checkpointLocation", checkpoint).partitionBy(QUARANTINED).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(path)
