"""Vector arithmetic and score losses on embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, sql_draw, sql_uniform, table
from tallyloom.functions import vectors as vf

_V = "embedding::DOUBLE[]"
_MEAN = f"(list_sum({_V}) / len(embedding))"


def _rows(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


@query(f"""SELECT vec_id, round(list_sum(list_transform({_V}, lambda x: x / 255)), 9) AS rescaled,
 array_to_string(list_transform({_V}, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), '') AS marks,
 (list_position({_V}, list_max({_V})) - 1)::INT AS best,
 round(list_dot_product({_V}, {_V}), 9) AS norm2, round(1 / (1 + exp(-list_sum({_V}))), 9) AS squashed FROM embeddings""")
def vector_ops(spark, folder):
    v = F.col("v")
    return _rows(spark, folder).select(
        "vec_id", F.round(vf.total(vf.rescale(v)), 9).alias("rescaled"),
        F.array_join(vf.nonzero(v).cast("array<string>"), "").alias("marks"), vf.argmax(v).alias("best"),
        F.round(vf.dot(v, v), 9).alias("norm2"), F.round(vf.sigmoid(vf.total(v)), 9).alias("squashed"))


@query(f"""WITH f AS (SELECT vec_id, {_V} AS v, CASE WHEN {sql_uniform('vec_id')} < 0.5 THEN list_reverse({_V}) ELSE {_V} END AS flipped,
 0.7::DOUBLE + {sql_uniform('vec_id', 'c')} * 0.6::DOUBLE AS factor, {_MEAN} AS m FROM embeddings)
 SELECT vec_id, round(flipped[1], 9) AS first_flipped, round((v[1] - m) * factor + m, 9) AS first_contrast,
 round((v[64] - m) * factor + m, 9) AS last_contrast FROM f""")
def vector_augment(spark, folder):
    flipped = vf.random_flip("v", "vec_id")
    contrast = vf.random_contrast("v", "vec_id", seed="c")
    return _rows(spark, folder).select("vec_id", flipped.alias("f"), contrast.alias("c")).select(
        "vec_id", F.round(F.col("f")[0], 9).alias("first_flipped"), F.round(F.col("c")[0], 9).alias("first_contrast"),
        F.round(F.col("c")[63], 9).alias("last_contrast"))


@query(f"""WITH h AS (SELECT vec_id, {_V} AS v, ({_V})[1:32] AS mu, ({_V})[33:64] AS s FROM embeddings),
 e AS (SELECT h.vec_id, list_sum(list_transform(range(1, 33), lambda i: exp(s[i]) + mu[i] * mu[i] - 1 - s[i])) * 0.5 AS penalty,
   list_sum(list_transform(range(1, 33), lambda i: abs(mu[i] - s[i]))) / 32 AS mae,
   list_sum(list_transform(range(1, 33), lambda i: (mu[i] - s[i]) * (mu[i] - s[i]))) / 32 AS mse FROM h)
 SELECT vec_id, round(penalty, 9) AS penalty, round(mae, 9) AS mae, round(mse, 9) AS mse,
 round(0.0005::DOUBLE * penalty + mae, 9) AS loss FROM e""")
def latent_losses(spark, folder):
    mu, s = vf.halves("v")
    return _rows(spark, folder).select("vec_id", mu.alias("mu"), s.alias("s")).select(
        "vec_id", F.round(vf.latent_penalty("mu", "s"), 9).alias("penalty"),
        F.round(vf.mean_absolute_gap("mu", "s"), 9).alias("mae"), F.round(vf.mean_squared_gap("mu", "s"), 9).alias("mse"),
        F.round(vf.latent_loss("mu", "s", "mu", "s"), 9).alias("loss"))


def _normal_sql(i: str) -> str:
    key = f"vec_id || ':' || {i}"
    return (f"sqrt(-2.0 * ln(({sql_draw(key, '13a')} + 1) / 4503599627370496::DOUBLE)) "
            f"* cos(2.0 * pi() * {sql_uniform(key, '13b')})")


@query(f"""SELECT vec_id, round({_normal_sql('1')}, 8) AS e1, round({_normal_sql('32')}, 8) AS e32,
 round(embedding[1]::DOUBLE + exp(embedding[33]::DOUBLE * 0.5) * {_normal_sql('1')}, 8) AS z1 FROM embeddings""")
def latent_draws(spark, folder):
    mu, s = vf.halves("v")
    noisy = _rows(spark, folder).select(
        "vec_id", mu.alias("mu"), s.alias("s"), vf.normal_vector(32, "vec_id").alias("e"))
    return noisy.select(
        "vec_id", F.round(F.col("e")[0], 8).alias("e1"), F.round(F.col("e")[31], 8).alias("e32"),
        F.round(vf.latent_draw("mu", "s", "e")[0], 8).alias("z1"))


_BCE = "greatest(x, 0) - x * {z} + ln(1 + exp(-abs(x)))"


@query(f"""WITH s AS (SELECT embedding[1]::DOUBLE * 10 AS x, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS y FROM embeddings),
 r AS (SELECT avg({_BCE.format(z='y')}) AS real_loss, avg({_BCE.format(z='0')}) AS fake_loss, avg({_BCE.format(z='1')}) AS generator_loss FROM s)
 SELECT round(real_loss, 9) AS real_loss, round(fake_loss, 9) AS fake_loss, round(real_loss + fake_loss, 9) AS discriminator_loss,
 round(generator_loss, 9) AS generator_loss FROM r""")
def bce_loss(spark, folder):
    scored = _rows(spark, folder).select(
        (F.col("v")[0] * 10).alias("x"), F.when(F.col("label") >= 5, 1).otherwise(0).alias("y"))
    parts = scored.agg(
        F.avg(vf.logit_cross_entropy("x", "y")).alias("real"),
        F.avg(vf.logit_cross_entropy("x", F.lit(0.0))).alias("fake"),
        F.avg(vf.logit_cross_entropy("x", F.lit(1.0))).alias("generator"))
    return parts.select(
        F.round("real", 9).alias("real_loss"), F.round("fake", 9).alias("fake_loss"),
        F.round(F.col("real") + F.col("fake"), 9).alias("discriminator_loss"), F.round("generator", 9).alias("generator_loss"))
