"""The registered queries of the operators, over the driver's tables, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tq.llm import alignment, bpe, decontaminate, fingerprint, jaccard, langid, license, minhash, periodic, quality, suffixes, toxicity, urls
from tq.llm.common import held_out, table
from tq.llm.oracles import ORACLES


__all__ = ["ORACLES", "QUERIES", "tokenizer_path"]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary files are; TOKENIZERS_DIR overrides the installed package."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def with_fold(scored: DataFrame) -> DataFrame:
    return scored.withColumn("held_out", held_out())


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = with_fold(quality.scores(docs, model))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = with_fold(toxicity.scores(docs, model))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.grouped(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = with_fold(langid.predictions(docs, langid.train(docs)))
    return scored.select("doc_id", "held_out", "lang_pred", "score")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.judged(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined_classes(table(spark, sf_dir, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with a planted period in the texts of which crc32 of the id ends in 0: from word a on, the first p words
    from there again and again. A null id leaves its text as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n = F.size(words).cast("long")
    g = F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    part = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int")))
    whole = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
    return docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), F.array_join(whole, " ")).otherwise(F.col("text")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.judged(with_periods(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_bpe": op4_bpe,
    "op5_url_filter": op5_url_filter,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_fingerprint": op9_fingerprint,
    "op10_language_id": op10_language_id,
    "op11_token_alignment": op11_token_alignment,
    "op12_ngram_join": op12_ngram_join,
    "op13_periodic_runs": op13_periodic_runs,
}
