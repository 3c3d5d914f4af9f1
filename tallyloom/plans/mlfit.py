"""Thin use of ``pyspark.ml`` for the library models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Interaction
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F


def dense_vectors(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    """Short numeric arrays as ML vectors."""
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def sparse_vectors(docs: DataFrame, terms: Sequence[str], factors: Sequence[float] | None = None,
                   words: str = "words", out: str = "features") -> DataFrame:
    """Presence / length (times ``factors``, one per term) as sparse ML vectors, one row per document.

    ``terms`` is the dictionary in position order; it goes to every task, so it is
    as bounded as the dictionary is.  Documents without words drop out.
    """
    presence = CountVectorizerModel.from_vocabulary(list(terms), inputCol=words, outputCol="_presence")
    presence.setBinary(True)
    share = F.try_divide(F.lit(1.0), F.size(words))
    scaled = Interaction(inputCols=["_share", "_presence"], outputCol="_tf")
    known = docs.where(F.size(words) > 0).withColumn("_share", share)
    df = scaled.transform(presence.transform(known))
    if factors is None:
        df = df.withColumnRenamed("_tf", out)
    else:
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(list(factors)), inputCol="_tf", outputCol=out)
        df = weigh.transform(df).drop("_tf")
    return df.drop("_presence", "_share")


def entries(df: DataFrame, features: str = "features", at: str = "at", values: str = "values") -> DataFrame:
    """Positions and values of a vector's components that are not zero, also where the library keeps a short vector dense."""
    inner = F.unwrap_udt(features)
    v = inner["values"]
    places = F.coalesce(inner["indices"], F.transform(v, lambda x, i: i))
    held = F.filter(F.arrays_zip(places.alias("at"), v.alias("v")), lambda e: e["v"] != 0)
    return df.withColumn("_held", held).withColumns({
        at: F.transform("_held", lambda e: e["at"]), values: F.transform("_held", lambda e: e["v"])}).drop("_held", features)


def fit_multinomial(df: DataFrame, label: str = "label", features: str = "features", passes: int = 200,
                    penalty: float = 1.0):
    """Multinomial logistic regression by LBFGS with an L2 penalty and no intercept."""
    return LogisticRegression(
        family="multinomial", maxIter=passes, regParam=penalty, elasticNetParam=0.0, fitIntercept=False,
        standardization=True, tol=1e-6, labelCol=label, featuresCol=features, predictionCol="pred",
    ).fit(df)


def fit_forest(df: DataFrame, label: str = "label", features: str = "features", trees: int = 3, depth: int = 4,
               bins: int = 32, seed: int = 13):
    """Random forest of gini trees."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=bins, impurity="gini", featureSubsetStrategy="auto", seed=seed,
        labelCol=label, featuresCol=features, predictionCol="pred",
    ).fit(df)


def predict(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predictions next to the labels they belong to, so nothing has to be zipped by position."""
    return model.transform(df).select(*keep, "pred")


def evaluate(scored: DataFrame, label: str = "label", of_class: float = 1.0, beta: float = 1.0) -> dict[str, float]:
    """F measure of one class and overall accuracy."""
    typed = scored.select(F.col(label).cast("double").alias("label"), F.col("pred").cast("double").alias("pred"))
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="pred", metricLabel=of_class, beta=beta)
    return {
        "f_score": judge.evaluate(typed, {judge.metricName: "fMeasureByLabel"}),
        "accuracy": judge.evaluate(typed, {judge.metricName: "accuracy"}),
    }
