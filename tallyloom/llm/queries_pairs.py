"""Queries over pairs, neighbours and vectors: near-duplicates, preferences, top-k, fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import forest, preference, simhash, topk, winnow
from tallyloom.llm.registry import query, table


@query()
def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    classes = simhash.near_classes(table(spark, folder, "documents"), distance=4)
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


_RENDER = "list_aggregate([''] || list_transform({0}, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), 'string_agg', '')"
_SPANS = """array_to_string(list_transform(list_filter(list_transform(range(1, len({0}) + 1), lambda i: {{'role': {0}[i].role,
      'start': coalesce(list_sum(list_transform({0}[1:i-1], lambda x: length(x.role) + length(x.text) + 13)), 0) + length({0}[i].role) + 5,
      'size': length({0}[i].text)}}), lambda x: x.role = 'assistant'),
      lambda x: x.start::BIGINT::VARCHAR || ':' || (x.start + x.size)::BIGINT::VARCHAR), ',')"""


@query(sql=f"""
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side,
    list({{'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')}}
      ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL
), p AS (
  SELECT pair_id, coalesce(any_value(ts) FILTER (side = 0), []) AS c, coalesce(any_value(ts) FILTER (side = 1), []) AS r
  FROM t GROUP BY pair_id
), d AS (
  SELECT *, least(len(c), len(r)) AS m,
    list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i].role <> r[i].role OR c[i].text <> r[i].text)) AS d FROM p
), n AS (SELECT *, coalesce(d - 1, m) AS n FROM d),
s AS (SELECT pair_id, n, c[1:n] AS p, c[n+1:] AS c, r[n+1:] AS r FROM n)
SELECT pair_id, n::INT AS n_prompt_turns, {_RENDER.format('p')} AS prompt, {_RENDER.format('c')} AS chosen,
  {_RENDER.format('r')} AS rejected, {_SPANS.format('c')} AS chosen_spans, {_SPANS.format('r')} AS rejected_spans
FROM s""")
def op2_preference_format(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations 2i and 2i + 1 as chosen and rejected; spans as text ``start:stop,...``."""
    conv = table(spark, folder, "conversations")
    side = F.when(F.pmod("conv_id", F.lit(2)) == 0, "chosen").otherwise("rejected")
    sided = preference.turns(conv, F.floor(F.col("conv_id") / 2).cast("bigint"), side)
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["stop"])), ",").alias(c)
    return preference.preference_pairs(sided).select(
        "pair_id", "n_prompt_turns", "prompt", "chosen", "rejected", spans("chosen_spans"), spans("rejected_spans"))


@query(sql="""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.own, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.own <> a.own AND len(a.q) = len(b.q)
), r AS (SELECT query_id, (row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other rows for every row whose id 50 divides; rows that repeat an id are rows of their own."""
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)


@query()
def op9_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited text; null texts are empty, rows that repeat an id go by their text."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    follow = winnow.with_next(docs, "doc_id", ["text"], winnow.with_fingerprint, ("prints",))
    both = winnow.with_fingerprint(
        follow.withColumn("edited", winnow.edited(F.col("text"), F.col("next_text"))).drop("next_text"), "edited", "edited_prints")
    own, other, after = winnow.hashes_of(F.col("prints")), winnow.hashes_of(F.col("edited_prints")), winnow.hashes_of(F.col("next_prints"))
    return both.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        winnow.digest(F.col("prints")).alias("fingerprint"), winnow.digest(F.col("edited_prints")).alias("edited_fingerprint"),
        winnow.likeness(own, other).alias("near_edited"), winnow.likeness(own, after).alias("near_next"))


@query()
def op12_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of ``documents`` that share four fifths of their two-word shingles; the smallest id of each is kept."""
    classes = forest.near_classes(table(spark, folder, "documents"), limit=0.8, shingle=2)
    return classes.select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
