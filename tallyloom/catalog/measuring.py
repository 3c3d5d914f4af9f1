"""Confusion counts and rates of a fixed rule on labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.catalog.words import labelled_documents
from tallyloom.operators import measures, ordered


def _scored(spark, folder):
    """Rule: short documents are class 1, English ones class 2, others 0."""
    docs = labelled_documents(spark, folder)
    pred = F.when(F.col("n_chars") < 1200, 1).when(F.col("lang") == "en", 2).otherwise(0)
    return docs.select("doc_id", "label", pred.alias("pred"), (F.col("n_chars") / 4000.0).alias("score"), "toxic")


_SCORED_SQL = """WITH s AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 1 WHEN quality = 1 THEN 2 ELSE 0 END AS label,
 CASE WHEN n_chars < 1200 THEN 1 WHEN lang = 'en' THEN 2 ELSE 0 END AS pred, n_chars / 4000.0::DOUBLE AS score, toxic
 FROM documents JOIN labels USING (doc_id))"""


def _counts_sql(tn: str, fp: str, tp: str, fn: str) -> str:
    return (f"{_SCORED_SQL} SELECT count(*) FILTER ({tp}) AS tp, count(*) FILTER ({tn}) AS tn, "
            f"count(*) FILTER ({fp}) AS fp, count(*) FILTER ({fn}) AS fn FROM s")


@query(_counts_sql("label <> 2 AND pred <> 2", "label <> 2 AND pred = 2", "label = 2 AND pred = 2", "label = 2 AND pred <> 2"))
def confusion(spark, folder):
    return measures.confusion(_scored(spark, folder), 2)


@query(_counts_sql("label = 0 AND pred = 0", "label = 0 AND pred <> 0", "label = 2 AND pred = 2", "label = 2 AND pred <> 2"))
def confusion_exclude_other(spark, folder):
    return measures.confusion(_scored(spark, folder), 2, "exclude_other")


@query(_counts_sql("label <> 2 AND label = pred", "label <> 2 AND label <> pred", "label = 2 AND pred = 2", "label = 2 AND pred <> 2"))
def confusion_label_equality(spark, folder):
    return measures.confusion(_scored(spark, folder), 2, "label_equality")


@query(f"""SELECT *, round(tp / (tp + fp)::DOUBLE, 4) AS "precision", round(tp / (tp + fn)::DOUBLE, 4) AS recall,
 round(2 * (tp / (tp + fp)::DOUBLE) * (tp / (tp + fn)::DOUBLE) / (tp / (tp + fp)::DOUBLE + tp / (tp + fn)::DOUBLE), 4) AS f_score,
 round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 4) AS accuracy FROM
 ({_counts_sql("label <> 2 AND pred <> 2", "label <> 2 AND pred = 2", "label = 2 AND pred = 2", "label = 2 AND pred <> 2")})""")
def prf(spark, folder):
    return measures.rates(measures.confusion(_scored(spark, folder), 2))


@query(f"""SELECT *, round(tp / (tp + (fp + fn) / 2.0::DOUBLE), 2) AS f_score FROM ({_SCORED_SQL}
 SELECT count(*) FILTER (toxic = 1 AND score > 0.5) AS tp, count(*) FILTER (toxic = 0 AND score <= 0.5) AS tn,
 count(*) FILTER (toxic = 0 AND score > 0.5) AS fp, count(*) FILTER (toxic = 1 AND score <= 0.5) AS fn FROM s)""")
def confusion_at_threshold(spark, folder):
    return measures.confusion_at(_scored(spark, folder), "score", "toxic", 0.5)


@query(f"""{_SCORED_SQL}, k AS (SELECT label AS class FROM s UNION SELECT pred FROM s),
 c AS (SELECT class, (SELECT count(*) FROM s WHERE label = class AND pred = class) AS tp,
  (SELECT count(*) FROM s WHERE label = class) AS nl, (SELECT count(*) FROM s WHERE pred = class) AS np FROM k)
 SELECT class, round(tp / np::DOUBLE, 9) AS "precision", round(tp / nl::DOUBLE, 9) AS recall,
 round(2.0 * (tp / np::DOUBLE) * (tp / nl::DOUBLE) / (tp / np::DOUBLE + tp / nl::DOUBLE), 9) AS f FROM c""")
def f_by_label(spark, folder):
    out = measures.f_by_label(_scored(spark, folder))
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f")})


@query(f"{_SCORED_SQL} SELECT round(avg(CASE WHEN label = pred THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS accuracy FROM s")
def accuracy(spark, folder):
    return measures.accuracy(_scored(spark, folder)).withColumn("accuracy", F.round("accuracy", 9))


@query(f"""{_SCORED_SQL} SELECT round(avg(CASE WHEN score >= 0.5 THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS error_ratio,
 round(1 - avg(CASE WHEN score >= 0.5 THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS accuracy FROM s WHERE toxic = 0""")
def misclass_ratio(spark, folder):
    out = measures.misclassified(_scored(spark, folder).where("toxic = 0"), "score")
    return out.withColumns({c: F.round(c, 9) for c in ("error_ratio", "accuracy")})


_W = [2000.0, 1400.0, -300.0, 150.0]
_PRED = "(2000.0::DOUBLE + 1400.0::DOUBLE * l_quantity - 300.0::DOUBLE * l_discount + 150.0::DOUBLE * l_tax)"


def _linear(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn("one", F.lit(1.0)).withColumn("y", F.col("l_extendedprice"))
    return measures.score_columns(rows, _W, ["one", "l_quantity", "l_discount", "l_tax"])


@query(f"SELECT l_orderkey, l_linenumber, round({_PRED}, 4) AS pred FROM lineitem")
def score_linear(spark, folder):
    return _linear(spark, folder).select("l_orderkey", "l_linenumber", F.round("pred", 4).alias("pred"))


@query(f"""SELECT round(sum(l_extendedprice), 1) AS sum_y, round(sum({_PRED}), 1) AS sum_pred, count(*) AS n,
 round(avg(pow(l_extendedprice - {_PRED}, 2)), 2) AS mse FROM lineitem""")
def mse(spark, folder):
    out = measures.mean_squared_error(_linear(spark, folder))
    return out.select(
        F.round("sum_y", 1).alias("sum_y"), F.round("sum_pred", 1).alias("sum_pred"), "n", F.round("mse", 2).alias("mse"))


@query("""WITH a AS (SELECT doc_id, n_chars > 1000 AS pred, row_number() OVER (ORDER BY doc_id) AS i FROM documents JOIN labels USING (doc_id)),
 b AS (SELECT quality = 1 AS target, row_number() OVER (ORDER BY doc_id) AS i FROM labels)
 SELECT doc_id, pred, target FROM a JOIN b USING (i)""")
def zip_predictions(spark, folder):
    """Predictions and targets that share nothing but the order of their rows."""
    labels = table(spark, folder, "labels")
    predicted = table(spark, folder, "documents").join(labels, "doc_id", "left_semi").select("doc_id", (F.col("n_chars") > 1000).alias("pred"))
    targets = labels.select(F.col("doc_id").alias("of"), (F.col("quality") == 1).alias("target"))
    return ordered.zip_rows(predicted, targets, ["doc_id"], ["of"]).drop("of")
