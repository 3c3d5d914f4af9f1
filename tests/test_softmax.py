"""Multinomial regression against plain NumPy and the library's optimiser."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators.sampling import weighted_split
from tallyloom.plans import documents, mlfit, softmax

RNG = np.random.default_rng(2)


def plain_gradient(fit, x, label, penalty):
    """Penalised gradient for scaled weights, at the fit."""
    spread = x.std(0, ddof=1)
    scaled = fit.weights * spread
    z = np.divide(x, spread, out=np.zeros_like(x), where=spread > 1e-12)
    m = z @ scaled.T
    p = np.exp(m - m.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    return (p - np.equal.outer(label, np.array(fit.classes))).T @ z / len(x) + penalty * scaled


@pytest.fixture(scope="module")
def data(spark):
    x = RNG.normal(size=(150, 6)) * [1, 5, 0.1, 2, 1, 0] + [0, 0, 0, 1, 0, 3]
    label = (x[:, 0] + RNG.normal(size=150) > 0).astype(int) + 2 * (x[:, 1] > 2)
    rows = [(i, float(y), [float(v) for v in r]) for i, (y, r) in enumerate(zip(label, x))]
    df = spark.createDataFrame(rows, "doc_id int, label double, x array<double>").repartition(5)
    return df, softmax.exploded(df, "x", ["doc_id", "label"]), x, label


@pytest.mark.parametrize("penalty", [1.0, 0.01])
def test_fit_is_optimal(data, penalty):
    _, features, x, label = data
    fit = softmax.fit_softmax(features, 6, penalty)
    assert fit.certificate < 1e-8 and np.abs(plain_gradient(fit, x, label, penalty)).max() < 1e-8
    assert fit.losses == sorted(fit.losses, reverse=True) and (fit.weights[:, 5] == 0).all()


def test_equals_the_library(data):
    df, features, _, _ = data
    fit = softmax.fit_softmax(features, 6, 0.1)
    model = mlfit.fit_multinomial(mlfit.dense_vectors(df, "x"), penalty=0.1)
    assert np.allclose(np.array(model.coefficientMatrix.toArray()), fit.weights, atol=1e-4)
    mine = {r["doc_id"]: r["pred"] for r in softmax.predict_softmax(features, fit).collect()}
    assert mine == {r["doc_id"]: r["pred"] for r in mlfit.predict(model, mlfit.dense_vectors(df, "x"), ["doc_id"]).collect()}


def test_a_cut_fit_says_so(data):
    _, features, x, label = data
    fit = softmax.fit_softmax(features, 6, 0.01, passes=4)
    assert fit.certificate > 1e-6 and fit.certificate == pytest.approx(np.abs(plain_gradient(fit, x, label, 0.01)).max())


def test_minimiser_on_a_narrow_valley():
    scale = 10.0 ** np.arange(5)
    point, losses, certificate = softmax.minimised(lambda p: (float(scale @ (p - 1) ** 2) / 2, scale * (p - 1)), np.zeros(5), 400, 1e-8)
    assert np.allclose(point, 1) and certificate <= 1e-8 and losses == sorted(losses, reverse=True)


def test_one_class_and_no_rows(spark, data):
    features = data[1]
    assert softmax.fit_softmax(features.where("label = 1"), 6).weights.shape == (1, 6)
    with pytest.raises(ValueError, match="no rows"):
        softmax.fit_softmax(features.where("false"), 6)


def test_document_flow(spark, folder):
    from tallyloom.catalog.words import labelled_documents
    from tallyloom.functions.text import letter_words

    docs = labelled_documents(spark, folder).select("doc_id", "label", letter_words("text").alias("words"))
    train, test = weighted_split(docs, "doc_id", [0.8, 0.2])
    rows = documents.run_documents(train, test, "multinomial", size=2000).collect()
    assert rows and all(r["certificate"] < 1e-6 and 0 <= r["accuracy"] <= 1 for r in rows)
