"""From raw documents to token ids: five stages, each on all rows that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the docs of the next; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tq.llm import bpe, decontaminate, langid, minhash, suffixes
from tq.llm.common import saved, table
from tq.llm.queries import tokenizer_path


#: Least score of a document's language. Every text gets the nearest learned language; a lower score says that it is in none.
SURE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, by a score of ``SURE`` or more; null texts and texts without a letter go."""
    return langid.accepted(docs, langid.train(docs), least=SURE)


#: Percent of the shingles that near copies share.
SIMILAR = 80


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (``SIMILAR`` percent of the five-word shingles), the one with the smallest id."""
    return minhash.one_of_each(docs, percent=SIMILAR)


#: Words of the shortest passage that goes where it stands anywhere else too.
PASSAGE_WORDS = 50


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of ``PASSAGE_WORDS`` words or more that stand anywhere else too; n_chars follows the text."""
    return suffixes.shortened(docs, shape=suffixes.Shape(PASSAGE_WORDS, words=True)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: doc_id, lang, source, n_chars, n_tokens, ids, round_trip."""
    return bpe.tokenized(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL: the stages learn, link transitively and encode; tests hold each against brute force.
ORACLE_SQL = None
