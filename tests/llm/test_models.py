"""Held-out accuracy of the trained operators, and rows that are hard for them."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tq.llm import langid, quality, toxicity
from tq.llm.common import held_out, table
from tq.llm.samples import sample_texts, smallest_hashes

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"
EDGE = [(None, "no id"), (1, None), (2, ""), (3, " \n"), (4, "12 34 ..."), (5, "x" * 60000), (6, "the"), (6, "the"), (7, "!!! ??? ..."), (8, "ö")]


def edge_docs(spark):
    return spark.createDataFrame([(i, t, 1.5, "f", 3) for i, t in EDGE], "doc_id long, text string, score double, features string, label int")


def test_folds(spark):
    ids = spark.range(300).withColumnRenamed("id", "doc_id").withColumn("h", held_out())
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in ids.collect())


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'a' when id < 20 then 'b' when id < 25 then null else 'c' end as label")
    drawn = lambda n: sorted(map(tuple, smallest_hashes(rows.repartition(n), F.col("label"), 50).collect()))
    assert drawn(2) == drawn(9)
    counts = {}
    for _, label in drawn(2):
        counts[label] = counts.get(label, 0) + 1
    assert counts == {"a": 50, "b": 13, "c": 50}


def test_samples_of_repeated_ids(spark):
    """An id that holds a third of the rows, other labels and copies: the sample keeps its bound and its labels."""
    rows = [(7, f"text {i}", "a") for i in range(2000)] + [(8, "one text", "b")] * 1000 + [(i, f"own {i}", "c") for i in range(9, 2009)] + [(i, f"no label {i}", None) for i in range(9, 2009)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    chosen = smallest_hashes(docs, F.col("lang"), 300, text="text")
    got = sample_texts(docs, chosen, label=F.col("lang")).collect()
    assert len(got) == len(set(got)) == 601 and {tuple(r) for r in got} <= {(i, lang, t) for i, t, lang in rows}
    assert [sum(r.label == x for r in got) for x in "abc"] == [300, 1, 300]
    # drawn by id alone, as for labels of another table: one text of each id, the same one on each run
    by_id = smallest_hashes(docs.where("lang is not null").dropDuplicates(["doc_id"]), F.lit(1), 5000)
    texts = [sorted(map(tuple, sample_texts(docs.repartition(n), by_id).collect())) for n in (2, 7)]
    assert texts[0] == texts[1] and [i for i, _, _ in texts[0]] == [7, 8, *range(9, 2009)]


def test_training_on_repeated_ids(spark):
    words = {"en": "the and of to in", "fr": "le la les des et"}
    rows = [(3, f"{words['en']} {i}", "en") for i in range(1500)] + [(5, f"{words['fr']} {i % 2}", "fr") for i in range(1500)] + [(5, words["en"], None)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").where(~held_out()).repartition(3)
    seen = {r.lang for r in docs.where("lang is not null").select("lang").distinct().collect()}
    model = langid.train(docs)
    assert set(model.languages) == seen
    known = spark.createDataFrame([(3, 1, 1), (5, 0, 0)], LABELS)
    for module in (quality, toxicity):
        scored = quality.scores(docs, module.train(docs, known))
        assert scored.count() == docs.count()


def labelled(spark, scored, label):
    labels = table(spark, SF, "labels").select("doc_id", F.col(label).alias("y"))
    rows = scored.join(labels, "doc_id").where(held_out()).collect()
    return np.array([r.score for r in rows]), np.array([r.y for r in rows])


def area(score, y):
    """Probability that a row of label 1 scores above one of label 0."""
    order = np.argsort(np.argsort(score))
    n, m = (y == 1).sum(), (y == 0).sum()
    return (order[y == 1].sum() - n * (n - 1) / 2) / (n * m)


def test_quality_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    model = quality.train(docs, table(spark, SF, "labels"))
    score, y = labelled(spark, quality.scores(docs, model), "quality")
    assert area(score, y) > 0.99
    assert ((score >= 0.5) == y).mean() > 0.97


def test_toxicity_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs, table(spark, SF, "labels"))
    score, y = labelled(spark, toxicity.scores(docs, model), "toxic")
    assert area(score, y) > 0.97
    flagged = score >= 0.7
    assert flagged[y == 1].mean() > 0.88 and flagged[y == 0].mean() < 0.03
    # the sentences found are parts of documents that score high
    found = toxicity.offending(docs, model, 0.7).select("doc_id", "start", "stop").distinct()
    high = {r.doc_id for r in quality.scores(docs, model).where("score >= 0.7").collect()}
    assert {r.doc_id for r in found.collect()} <= high


def test_language_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    got = langid.predictions(docs, langid.train(docs)).withColumnRenamed("score", "s")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where(held_out() & F.col("lang").isNotNull()).collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98


def test_a_hierarchy_with_one_of_everything():
    texts = [b"the and of to in " * 5, b"der und die das ist " * 5, b"le la les des et " * 5, b"kissa koira talo auto " * 5]
    model = langid.fit(texts * 4, ["en", "de", "fr", "fi"] * 4)
    assert model.predict(texts)[0] == ["en", "de", "fr", "fi"]
    assert [p for p in model.pairs if not p[0].startswith("family:")] == [("de", "en")]
    only = langid.fit(texts[:1] * 3, ["en"] * 3)
    assert only.predict(texts)[0] == ["en"] * 4


@pytest.mark.parametrize("labels", [[], [(5, 1, 1)], [(5, None, None), (None, 1, 1)], [(5, 1, 0), (6, 0, 1), (6, 1, 0), (2, 0, 0), (4, 1, 1), (8, 1, 1)]])
def test_edge_rows_and_labels(spark, labels):
    docs, known = edge_docs(spark), spark.createDataFrame(labels, LABELS)
    for module in (quality, toxicity):
        model = module.train(docs, known)
        got = [(r.doc_id, r.score) for r in quality.scores(docs, model).collect()]
        assert sorted(map(str, (i for i, _ in got))) == sorted(str(i) for i, _ in EDGE)
        assert all(0.0 <= s <= 1.0 for _, s in got)
        assert len({s for i, s in got if i in (1, 2)}) == 1 == len({s for i, s in got if i == 6})
        assert quality.scores(docs.where("false"), module.train(docs.where("false"), known)).count() == 0


def test_language_edge_rows(spark):
    docs = edge_docs(spark).withColumn("lang", F.when(F.col("doc_id") > 4, F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr")))
    got = langid.predictions(docs, langid.train(docs)).collect()
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 4, 7)} == {"und"}
    assert all(r.lang_pred in ("en", "fr") for r in got if r.doc_id in (5, 6, 8)) and all(0 <= r.score <= 1 for r in got)
    nothing = langid.train(docs.where("false"))
    assert {r.lang_pred for r in langid.predictions(docs, nothing).collect()} == {"und"}
    assert langid.accepted(docs, nothing).count() == 0


def test_offending_sentences():
    texts = [b"A calm line. You are a zork! Fine.", b"Nothing here. At all.", b"zork"] * 30 + [b"Good words only. Fine."] * 60
    model = toxicity.fit(texts, np.array([1, 0, 1] * 30 + [0] * 60))
    bags, z = model.sentences(texts[:1])
    assert [texts[0][a:b].strip() for a, b in bags.spans[z > 0]] == [b"You are a zork"]
