"""Corpus pipeline: language ID, near duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the runner writes it as Parquet
and reads it back as the next stage's docs.  All but the last return the columns of
``documents``.  Decisions take effect: a later stage sees only what the earlier ones kept.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlab.llm import bpe, decontam, jaccard, langid, pii
from loanlab.llm.queries import tokenizer_path
from loanlab.llm.text import broadcast_if_small, reliable, table
from loanlab.session import scratch_path

#: A byte costs eight bits without any model; text that the best language codes worse is none of them.
MOST_BITS = 8.0


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in the materialised ``gone``; null ids stay."""
    return docs.join(broadcast_if_small(gone, 48), "doc_id", "left_anti").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those that no learned language codes in under
    eight bits a byte.  Labels for learning come from these documents."""
    model = langid.train(docs.where("doc_id is not null").where(~langid.held_out()).select("doc_id", "text", "lang"))
    verdict = langid.predict(docs, model)
    gone = reliable(verdict.where((F.col("lang_pred") == "und") | (F.col("bits_per_byte") >= MOST_BITS)).select("doc_id").distinct())
    nameless = F.col("doc_id").isNull() & (F.col("text").isNull() | ~F.col("text").rlike(langid.LETTER))
    return _without(docs, gone.where("doc_id is not null")).where(~nameless)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id; rows that
    repeat a doc_id count as one document."""
    parts = reliable(jaccard.jaccard_components(docs))
    gone = reliable(parts.where("doc_id <> component_id").select("doc_id").distinct())
    kept = _without(docs, gone)
    twice = reliable(parts.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1 and doc_id is not null").select("doc_id"))
    if not twice.take(1):
        return kept
    one = kept.join(twice, "doc_id", "left_semi").select(*docs.columns)
    return _without(kept, twice).unionByName(one.dropDuplicates(["doc_id"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    hits = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, reliable(hits.select("doc_id").distinct()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; n_chars follows the text where that changed."""
    out = pii.pseudonymise(docs)
    chars = F.when(F.col("_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from them."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("tokens", tokens)]

ORACLE_SQL = None  # learned, iterative and keyed stages: tested against brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
