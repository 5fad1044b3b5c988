"""License scans by diagonal voting, with DataFrame functions only.

Every rolling word 3-gram of a text is joined to the 3-grams of the license templates. A hit at word
``pos`` of the text and ``tpos`` of the template votes for the diagonal ``pos - tpos``: an unbroken
quote puts all its votes on one diagonal, a word added or left out moves the rest to the next one.
Votes are added up per diagonal, diagonals up to ``SLACK`` apart are merged into one span, and a span
stands if the words it covers, counted word by word in a bit mask of the template, are enough of the
template. Base phrases must stand whole, on one diagonal.

The template table is a fixed list (checked: at most 62 words each), so it is broadcast, and the joined
grams never leave their task: what is shuffled is one row per hit, and one row per document that
carries its word count.

Rows: each row of the input gives one row, also with a null or repeated id; null text counts as empty;
without a span ``labels`` is the empty text and ``score`` 0. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tq.llm.common import letter_words

GRAM = 3
#: Diagonals at most so far apart, counted from one to the next, are one quote with words added or left out.
SLACK = 2
#: The share of a template's words that a span must cover; templates under SHORT words must stand whole.
COVER, SHORT = 0.75, 8

#: Base phrases and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: Further templates and their labels.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-sa", "cc by sa"),
    ("gpl", "under the gnu general public license"),
    ("gpl", "the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("all-rights-reserved", "all rights reserved"),
)


def template_grams(spark: SparkSession) -> DataFrame:
    """(template, base, label, size, tpos, w0, w1, w2), and one row with a line end as w0 that meets each text's end mark."""
    rows = ["(-1, false, cast(null as string), 0, 0, '\\n', '', '')"]
    for i, (label, phrase) in enumerate((*BASE, *TEMPLATES)):
        words = phrase.split()
        if not GRAM <= len(words) <= 62:
            raise ValueError(f"a template has {GRAM} to 62 words: {phrase}")
        base = str(i < len(BASE)).lower()
        for at in range(len(words) - GRAM + 1):
            a, b, c = words[at : at + GRAM]
            rows.append(f"({i}, {base}, '{label}', {len(words)}, {at}, '{a}', '{b}', '{c}')")
    names = "template, base, label, size, tpos, w0, w1, w2"
    return spark.sql(f"SELECT *, xxhash64(w0, w1, w2) AS gram FROM VALUES {', '.join(rows)} AS t({names})")


def hits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per gram of a text that stands in a template, and one with template -1 and the word count."""
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.concat(letter_words(F.col(text)), F.array(F.lit("\n"))).alias("words"),
    )
    grams = words.select("row", "doc_id", "words", F.posexplode("words").alias("pos", "word"))
    w = lambda n: F.coalesce(F.get("words", F.col("pos") + n), F.lit(""))
    known = F.broadcast(template_grams(docs.sparkSession))
    same = (
        (F.xxhash64(F.col("word"), w(1), w(2)) == F.col("gram"))
        & (F.col("word") == F.col("w0"))
        & (w(1) == F.col("w1"))
        & (w(2) == F.col("w2"))
    )
    return grams.join(known, same).select("row", "doc_id", "template", "base", "label", "size", "tpos", "pos")


def spans(found: DataFrame) -> DataFrame:
    """Votes per diagonal, then merged diagonals: (row, doc_id, template, base, label, size, first, words, whole, cover)."""
    keys = ["row", "doc_id", "template", "base", "label", "size"]
    mask = F.expr(f"bit_or(shiftleft({2**GRAM - 1}L, tpos))")
    diagonals = (
        found.withColumn("diagonal", F.when(F.col("template") >= 0, F.col("pos") - F.col("tpos")).otherwise(F.col("pos")))
        .groupBy(*keys, "diagonal")
        .agg(mask.alias("mask"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    )
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(near)
    starts = F.coalesce((step > SLACK) | F.col("base"), F.lit(True))  # diagonals of base phrases stay apart
    marked = diagonals.withColumn("starts", starts.cast("int"))
    numbered = marked.withColumn("span", F.sum("starts").over(near.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy(*keys, "span")
        .agg(F.expr("bit_or(mask)").alias("mask"), F.min("diagonal").alias("diagonal"), F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("cover", F.when(F.col("template") >= 0, F.bit_count("mask") / F.col("size")))
        .withColumn("stands", F.col("cover") >= F.when(F.col("base") | (F.col("size") < SHORT), 1.0).otherwise(COVER))
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: word count, base places and labels, all labels and the best cover."""
    # all that belongs to a row goes to one partition once; the aggregates and windows below reuse it
    found = spans(hits(docs, doc_id, text).repartition("row"))
    stands, base = F.col("stands"), F.col("stands") & F.col("base")
    names = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return (
        found.groupBy("row", "doc_id")
        .agg(
            F.max(F.when(F.col("template") < 0, F.col("diagonal"))).cast("long").alias("n_words"),
            F.count_if(F.coalesce(base, F.lit(False))).alias("n_base"),
            F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"),
            names(base).alias("base_labels"),
            names(stands).alias("labels"),
            F.coalesce(F.max(F.when(stands, F.col("cover"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
