"""Bounded training samples: the rows with the smallest hashes, class by class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tq.llm.common import discard, saved


def smallest_hashes(rows: DataFrame, label: Column, per_class: int, doc_id: str = "doc_id", text: str | None = None) -> DataFrame:
    """(doc_id, label) of at most ``per_class`` rows of each label, those with the smallest hash; with ``text``,
    (doc_id, label, text_hash), drawn by id and text.

    Rows that repeat a label, an id (and a text) count once, however many there are. Ties are broken by the id, so
    a repeated run takes the same rows. Only ids, labels and hashes are moved. The number of different rows of a
    label, estimated by a sketch, gives a threshold for the hashes that about three times ``per_class`` of them
    pass, so that no task ranks all rows of a label. Where fewer than ``per_class`` pass although a threshold cut
    some off, it is widened, so the result is exact. Null ids and labels go.
    """
    keys = ["doc_id"] if text is None else ["doc_id", "text_hash"]
    draw = F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))  # uniform in [0, 1)
    hashed = [] if text is None else [text_hash(text).alias("text_hash")]
    narrow = rows.select(F.col(doc_id).alias("doc_id"), label.alias("label"), *hashed).dropna().withColumn("draw", draw)
    counts = saved(narrow.groupBy("label").agg(F.approx_count_distinct("draw").alias("n")), "sample-counts")
    most = 3 * per_class + 100
    while True:
        # one row per label, a few labels: small enough to broadcast
        near = narrow.join(F.broadcast(counts), "label").where(F.col("draw") * F.col("n") < most)
        near = saved(near.select("label", "draw", *keys).distinct(), "sample-near")
        kept = near.groupBy("label").agg(F.count("*").alias("kept"))
        short = counts.join(F.broadcast(kept), "label", "left").where(F.coalesce("kept", F.lit(0)) < per_class)
        if short.where(F.col("n") > most).isEmpty():
            break
        discard(near)
        most *= 16
    discard(counts)
    order = Window.partitionBy("label").orderBy("draw", *keys)
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_class).select(keys[0], "label", *keys[1:])


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def sample_texts(rows: DataFrame, chosen: DataFrame, doc_id: str = "doc_id", text: str = "text", label: Column | None = None) -> DataFrame:
    """(doc_id, label, text), one row for each chosen one that has a text in ``rows``: of several texts the one with the
    smallest hash. ``chosen`` has a bound set by its caller, so it is broadcast. Where rows were drawn by their
    text, ``rows`` and ``label`` are those of the draw."""
    value = F.coalesce(F.col(text), F.lit(""))
    columns = [F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), value.alias("text")]
    narrow = rows.select(*columns, *([] if label is None else [label.alias("label")]))
    on = [c for c in narrow.columns if c in chosen.columns]
    met = narrow.join(F.broadcast(chosen), on)
    # combined map-side: an id that holds a third of all rows leaves each task as one row
    first = met.groupBy("doc_id", "label", *[c for c in on if c == "text_hash"]).agg(F.min(F.struct("text_hash", "text")).alias("first"))
    return first.select("doc_id", "label", F.col("first.text").alias("text"))
