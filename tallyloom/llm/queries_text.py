"""Queries over whole texts: token counts and packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import langid, mixing_lm, packing, repeats, tokens
from tallyloom.llm.registry import query, table


@query()
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query()
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(table(spark, folder, "documents"), keep=False)


@query()
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identified(table(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op4_context_mixing_scores(spark: SparkSession, folder: str) -> DataFrame:
    return mixing_lm.scored(table(spark, folder, "documents"))
