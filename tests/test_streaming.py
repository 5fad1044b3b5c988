"""Stateless row rules on a stream give the same reasons as the batch columns."""

from pyspark.sql import functions as F

from tq.config import LISTINGS
from tq.sources.files import read_partitioned
from tq.sources.tables import dirty
from tq.streaming.quarantine import reasoned_stream, start_quarantine_stream

from conftest import SF_SMALL


def test_stream_equals_batch(spark, tmp_path):
    d = dirty(spark, SF_SMALL)
    landing = str(tmp_path / "landing")
    d.write.parquet(landing)
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    q = start_quarantine_stream(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), LISTINGS, available_now=True)
    q.awaitTermination()
    streamed = read_partitioned(spark, str(tmp_path / "out"))
    batch = reasoned_stream(d, LISTINGS)
    assert streamed.count() == batch.count() == d.count()
    cols = sorted(batch.columns)
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert streamed.filter(F.col("quarantined")).count() == batch.filter(F.col("reject_reason") != "").count()
