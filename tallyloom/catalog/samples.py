"""Splits, batches and survey samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, sql_draw, sql_uniform, table
from tallyloom.operators import ordered, sampling, stats
from tallyloom.sources.lines import spread

SEED = 13


# -- splits ------------------------------------------------------------------------------

@query(f"""SELECT CASE WHEN {sql_uniform('doc_id')} < 0.8::DOUBLE THEN 0 ELSE 1 END AS split, lang, count(*) AS n
 FROM documents GROUP BY 1, 2""")
def hash_split_counts(spark, folder):
    docs = sampling.with_split(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id", [0.8, 0.2], SEED)
    return docs.groupBy("split", "lang").agg(F.count("*").alias("n"))


@query(f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_draw('doc_id')}, doc_id) AS i,
  count(*) OVER () AS n FROM documents)
 SELECT doc_id, CASE WHEN i <= floor(n * 0.7::DOUBLE) THEN 'train'
  WHEN i <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) + 1 THEN 'validation' ELSE 'test' END AS split FROM r""")
def three_way_split(spark, folder):
    return sampling.three_way_split(table(spark, folder, "documents").select("doc_id"), "doc_id", seed=SEED)


@query(f"""SELECT conv_id, turn, {sql_uniform("conv_id || ':' || turn")} < 0.2::DOUBLE AS held FROM conversations""")
def holdout_split(spark, folder):
    turns = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("path"))
    return turns.withColumn("held", sampling.hold_out(turns, "path", 0.2, SEED)).drop("path")


@query(f"""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
 WHERE {sql_uniform("l_orderkey || ':' || l_linenumber || ':' || 7")} < 500.0::DOUBLE / (SELECT count(*) FROM lineitem)""")
def minibatch_rows(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    total = rows.agg(F.count("*").cast("double").alias("n")).scalar()
    keyed = rows.withColumn("key", F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return sampling.mini_batch(keyed, "key", 500, total, 7, SEED).drop("key")


# -- batches -----------------------------------------------------------------------------

@query("""WITH b AS (SELECT event_id, value, (row_number() OVER (ORDER BY ts, event_id) - 1) // 132 AS batch_id FROM events)
 SELECT batch_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, round(sum(value), 4) AS total
 FROM b GROUP BY batch_id""")
def batches(spark, folder):
    events = table(spark, folder, "events").select("ts", "event_id", "value")
    marked = ordered.batches(events, ["ts", "event_id"], 132)
    return marked.groupBy("batch_id").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
        F.round(F.sum("value"), 4).alias("total"))


@query("SELECT ceil(count(*) / 132.0)::BIGINT AS batches FROM events")
def batch_count(spark, folder):
    return ordered.batch_count(table(spark, folder, "events"), 132)


@query(f"""WITH b AS (SELECT event_id, (row_number() OVER (ORDER BY {sql_draw('event_id')}, event_id) - 1) // 32 AS batch_id FROM events)
 SELECT event_id, batch_id < 18 AS validation FROM b""")
def validation_carveout(spark, folder):
    drawn = table(spark, folder, "events").select("event_id", sampling.draw("event_id", seed=SEED).alias("u"))
    marked = ordered.batches(drawn, ["u", "event_id"], 32)
    held = ordered.take_batches(marked, 18).select("event_id", F.lit(True).alias("validation"))
    return held.unionByName(ordered.skip_batches(marked, 18).select("event_id", F.lit(False).alias("validation")))


# -- samples of fixed size ------------------------------------------------------------------

@query(f"""SELECT event_id, event_type, value FROM events ORDER BY {sql_draw('event_id')}, event_id LIMIT 50""")
def srs_fixed_n(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return sampling.simple_random(events, "event_id", 50, SEED)


@query(f"""WITH r AS (SELECT sample_id, value, row_number() OVER (PARTITION BY sample_id
   ORDER BY {sql_draw("sample_id || ':' || event_id")}, event_id) AS i FROM events, range(1, 31) t(sample_id))
 SELECT sample_id::INT AS sample_id, round(avg(value), 6) AS mean FROM r WHERE i <= 50 GROUP BY sample_id""")
def srs_means(spark, folder):
    events = spread(table(spark, folder, "events").select("event_id", "value"))
    means = stats.sample_means(sampling.repeated_samples(events, "event_id", 50, 30, SEED), "value")
    return means.withColumn("mean", F.round("mean", 6))


@query(f"""WITH r AS (SELECT sample_id, value, row_number() OVER (PARTITION BY sample_id
   ORDER BY {sql_draw("sample_id || ':' || event_id")}, event_id) AS i FROM events, range(1, 31) t(sample_id)),
 m AS (SELECT avg(value) AS mean FROM r WHERE i <= 50 GROUP BY sample_id)
 SELECT round(avg(mean), 6) AS mean_of_means, round((SELECT avg(value) FROM events), 6) AS population_mean FROM m""")
def mean_of_means(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    means = stats.sample_means(sampling.repeated_samples(events, "event_id", 50, 30, SEED), "value")
    whole = events.agg(F.avg("value").alias("m")).scalar()
    return means.agg(F.round(F.avg("mean"), 6).alias("mean_of_means"), F.round(F.max(whole), 6).alias("population_mean"))


@query(f"""SELECT event_id, row_number() OVER (ORDER BY {sql_draw('event_id')}, event_id) AS place FROM events""")
def shuffled_places(spark, folder):
    return sampling.shuffled_places(table(spark, folder, "events").select("event_id"), "event_id", SEED)


@query(f"""WITH r AS (SELECT floor(value) AS v, row_number() OVER (ORDER BY event_id) AS i, count(*) OVER () AS n FROM events),
 d AS (SELECT floor({sql_uniform('i')} * n)::BIGINT + 1 AS i FROM r)
 SELECT r.v::BIGINT AS v, count(*) AS n, round(count(*) / (SELECT count(*) FROM d)::DOUBLE, 9) AS share
 FROM d JOIN r USING (i) GROUP BY r.v""")
def bootstrap_share(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.floor("value").alias("v"))
    drawn = sampling.bootstrap(events, ["event_id"], SEED)
    return stats.shares(drawn, "v", weight="times").withColumn("share", F.round("share", 9))


@query(f"""WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS i,
  ceil(count(*) OVER () / 20.0::DOUBLE)::BIGINT AS k FROM orders),
 s AS (SELECT *, floor({sql_uniform("'start'")} * k)::BIGINT + 1 AS f FROM r)
 SELECT o_orderkey, o_totalprice FROM s WHERE i >= f AND (i - f) % k = 0""")
def systematic(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    picked = sampling.systematic(orders, [F.desc("o_orderdate"), F.col("o_orderkey")], 20, seed=SEED)
    return picked.select("o_orderkey", "o_totalprice")


@query("""WITH f AS (SELECT event_type, count(*) AS freq FROM events GROUP BY event_type),
 t AS (SELECT *, sum(freq) OVER () AS total FROM f),
 e AS (SELECT *, (100 * freq) // total AS base, (100 * freq) % total AS rest FROM t),
 k AS (SELECT *, row_number() OVER (ORDER BY rest DESC, event_type) AS rk, 100 - sum(base) OVER () AS left_over FROM e)
 SELECT event_type, freq, (base + CASE WHEN rk <= left_over THEN 1 ELSE 0 END)::BIGINT AS size FROM k""")
def stratum_sizes(spark, folder):
    return sampling.proportional_sizes(table(spark, folder, "events"), "event_type", 100)


@query(f"""WITH f AS (SELECT event_type, count(*) AS freq FROM events GROUP BY event_type),
 t AS (SELECT *, sum(freq) OVER () AS total FROM f),
 e AS (SELECT *, (100 * freq) // total AS base, (100 * freq) % total AS rest FROM t),
 k AS (SELECT *, row_number() OVER (ORDER BY rest DESC, event_type) AS rk, 100 - sum(base) OVER () AS left_over FROM e),
 z AS (SELECT event_type, base + CASE WHEN rk <= left_over THEN 1 ELSE 0 END AS size FROM k),
 r AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY {sql_draw('event_id')}, event_id) AS i FROM events)
 SELECT event_id, event_type, value FROM r JOIN z USING (event_type) WHERE i <= size""")
def stratified(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return sampling.stratified(events, "event_type", "event_id", 100, SEED)


# -- unequal probabilities --------------------------------------------------------------------

@query("""SELECT o_orderkey, round(100 * o_totalprice / (SELECT sum(o_totalprice) FROM orders), 9) AS pik FROM orders""")
def pps_probabilities(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sampling.inclusion_probabilities(orders, "o_totalprice", 100).select("o_orderkey", F.round("pik", 9).alias("pik"))


_CAPPED_SQL = """WITH s AS (SELECT o_orderkey, o_totalprice AS a FROM orders),
 k AS (SELECT floor(0.6::DOUBLE * count(*)) AS n, sum(a) AS total FROM s),
 d AS (SELECT a, row_number() OVER (ORDER BY a DESC, o_orderkey) - 1 AS m,
   coalesce(sum(a) OVER (ORDER BY a DESC, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM s),
 f AS (SELECT arg_min(m, m) AS m0, arg_min(c, m) AS c0 FROM d, k WHERE (n - m) * a < total - c)
 SELECT o_orderkey, round(CASE WHEN a >= (total - c0) / (n - m0) THEN 1.0::DOUBLE ELSE (n - m0) * a / (total - c0) END, 9) AS pik
 FROM s, k, f"""


@query(_CAPPED_SQL)
def pps_capped(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    n = int(0.6 * orders.count())
    return sampling.inclusion_probabilities(orders, "o_totalprice", n).select("o_orderkey", F.round("pik", 9).alias("pik"))


@query("""WITH p AS (SELECT o_orderkey, o_totalprice,
   round(100 * o_totalprice / (SELECT sum(o_totalprice) FROM orders) * 1e12)::BIGINT AS p FROM orders),
 c AS (SELECT *, sum(p) OVER (ORDER BY o_orderkey)::BIGINT AS cum FROM p)
 SELECT o_orderkey, o_totalprice FROM c
 WHERE (((cum - p - 370000000000) % 1000000000000) + 1000000000000) % 1000000000000
     > (((cum - 370000000000) % 1000000000000) + 1000000000000) % 1000000000000""")
def pps_systematic(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    weighted = sampling.inclusion_probabilities(orders, "o_totalprice", 100)
    return sampling.pps_systematic(weighted, ["o_orderkey"], u=0.37).select("o_orderkey", "o_totalprice")


# -- balancing -------------------------------------------------------------------------------

@query(f"""WITH f AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic),
 g AS (SELECT toxic, n, (SELECT max(n) FROM f) AS big FROM f),
 r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {sql_draw('doc_id')}, doc_id) AS i FROM labels)
 SELECT doc_id, toxic, big // n + CASE WHEN i <= big % n THEN 1 ELSE 0 END AS copies FROM r JOIN g USING (toxic)""")
def upsample_minority(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return sampling.upsample(labels, "toxic", "doc_id", SEED).groupBy("doc_id", "toxic").agg(F.count("*").alias("copies"))


@query("SELECT round(count(*) FILTER (toxic = 1) / (count(*) FILTER (toxic = 0))::DOUBLE, 2) AS ratio FROM labels")
def class_ratio(spark, folder):
    return stats.class_ratio(table(spark, folder, "labels"), "toxic", 1, 0).withColumn("ratio", F.round("ratio", 2))


@query("""WITH s AS (SELECT row_number() OVER (ORDER BY score, vec_id) AS rank, score FROM
   (SELECT vec_id, round(1 / (1 + exp(-embedding[1]::DOUBLE)), 9) AS score FROM embeddings)),
 l AS (SELECT row_number() OVER (ORDER BY label, vec_id) AS rank, label FROM
   (SELECT vec_id, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS label FROM embeddings))
 SELECT rank, score, label FROM s JOIN l USING (rank)""")
def separability(spark, folder):
    from tallyloom.functions.vectors import sigmoid

    scored = table(spark, folder, "embeddings").select(
        "vec_id", F.round(sigmoid(F.col("embedding")[0].cast("double")), 9).alias("score"),
        F.when(F.col("label") >= 5, 1).otherwise(0).alias("label"))
    return sampling.separability(scored, "score", "label", "vec_id")
