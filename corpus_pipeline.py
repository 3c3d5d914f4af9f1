"""Corpus pipeline: known languages, one of each near-copy, no repeated passage, no toxic text, packed sequences."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import langid, mixture, packing, repeats, simhash
from tallyloom.session import use_checkpoint_dir

#: A document stays if its language is known and this sure.
LEAST_SCORE = 0.5
#: Rows handed to Python at once, and where Spark has that setting.
BATCH, ROWS_SETTING = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised (operator 5); a missing ``lang`` is filled in.

    Goes: null texts, texts without a letter, texts of which no language is sure.
    """
    docs = docs.select(*COLUMNS)
    names, network = langid.fitted(docs)
    found = langid.predicted(docs, names, network, COLUMNS)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near fingerprints (operator 1: four-word shingles, four bits)."""
    return simhash.near_deduplicated(docs.select(*COLUMNS))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 200 bytes that start anywhere else too (operator 8); no document goes."""
    return repeats.deduplicated(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose fitted rate rounds to a copy when toxic text gets no weight (operator 7).

    The classifier learns from the texts as they are at this stage and the table ``labels``.
    """
    return mixture.without_domain(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and place in it (operator 10)."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Learned models and repeated passages are beyond SQL: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    Stages that are written exchange texts with Python in batches of ``BATCH`` rows, for the memory of one
    executor holds what all of them use; the session's own setting is restored before the last stage.
    """
    folder = f"{use_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = spark.conf.get(ROWS_SETTING)
    spark.conf.set(ROWS_SETTING, min(int(own), BATCH) if int(own) > 0 else BATCH)
    try:
        for name, stage in STAGES[:-1]:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    finally:
        spark.conf.set(ROWS_SETTING, own)
    return STAGES[-1][1](spark, docs, sf_dir)
