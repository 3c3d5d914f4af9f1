import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.losses import hinge, logistic, weighted_hinge
from tallyloom.operators.measures import positive_share
from tallyloom.plans import descent, documents, mlfit, trips
from tallyloom.plans.timing import Phases

RNG = np.random.default_rng(5)


def reference_loop(evaluate, w, rate, tolerance, passes, record_last):
    """The step rule in plain NumPy."""
    old, losses = 0.0, []
    for i in range(passes):
        loss, gradient = evaluate(w)
        w = w - rate * gradient
        rate *= 1.05 if loss < old else 0.5
        stop = tolerance is not None and abs(loss - old) <= tolerance
        if record_last or not stop:
            losses.append(loss)
        if stop:
            break
        old = loss
    return w, losses


def test_linear_fit_equals_row_by_row_descent(spark):
    x = np.c_[np.ones(200), RNG.uniform(0, 5, (200, 2))]
    y = x @ [1.0, 2.0, -1.0] + RNG.normal(0, 0.1, 200)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")

    def evaluate(w):
        gap = y - x @ w
        return float(gap @ gap) / 200, -(x.T @ gap) / 200

    want, losses = reference_loop(evaluate, np.full(3, 0.1), 0.01, 1e-2, 300, False)
    fit = descent.fit_linear(df, ["a", "b", "c"], "y", rate=0.01, tolerance=1e-2)
    assert fit.weights == pytest.approx(want) and [v for _, v in fit.losses] == pytest.approx(losses)
    assert fit.loss_table(spark).count() == len(losses)


def test_empty_batches_are_skipped(spark):
    df = spark.range(3).select(F.col("id").alias("k"), F.lit(1.0).alias("a"), F.lit(2.0).alias("y"))
    fit = descent.fit_linear_batches(df, ["a"], "y", "k", size=1, passes=6)
    members = descent.batch_members(df, "k", 1, 3, 6).select("_pass").distinct().count()
    assert len(fit.losses) == members <= 6


@pytest.fixture(scope="module")
def sparse(spark):
    rows = []
    for d in range(40):
        for p in sorted(RNG.choice(12, 4, replace=False)):
            rows.append((f"d{d}", int(p), float(RNG.uniform(-0.5, 1.0)), int(d % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id string, pos int, value double, label int")
    dense, label = np.zeros((40, 12)), np.zeros(40)
    for d, p, v, y in rows:
        dense[int(d[1:]), p], label[int(d[1:])] = v, y
    return df, dense, label


@pytest.mark.parametrize("name", ["logistic", "hinge", "weighted"])
def test_margin_fit_equals_dense_descent(spark, sparse, name):
    df, x, label = sparse
    y = label if name == "logistic" else 2 * label - 1
    pr = float(label.mean())

    def evaluate(w):
        m = x @ w
        if name == "logistic":
            loss, slope = float((-y * m + np.log1p(np.exp(m))).sum()), 1 / (1 + np.exp(-m)) - y
            extra = 2 * 0.01 * np.linalg.norm(w)
            return loss + extra, x.T @ slope + extra
        weight = np.ones(40) if name == "hinge" else np.where(y > 0, 1 - pr, pr)
        loss = float(np.maximum(0, weight * (1 - y * m)).sum())
        gradient = x.T @ np.where(y * m > 1, 0, -y * weight)
        if name == "weighted":
            return loss, gradient
        r = 1 / (0.1 * 40)
        return r / 2 * np.linalg.norm(w) + loss / 40, r * w + gradient / 40

    model = {"logistic": logistic(), "hinge": hinge(), "weighted": weighted_hinge(pr)}[name]
    penalty = {"logistic": descent.scalar_norm_penalty(0.01), "hinge": descent.batch_norm_penalty(0.1, 40),
               "weighted": descent.no_penalty}[name]
    want, losses = reference_loop(evaluate, np.full(12, 0.1), 0.1, None, 4, True)
    marked = descent.with_target(df, F.col("label") == 1, model.negative)
    fit = descent.fit_margin(marked, 12, model, descent.Descent(0.1, None, 4), penalty)
    assert fit.weights == pytest.approx(want) and [v for _, v in fit.losses] == pytest.approx(losses)


def test_logistic_loss_falls_and_repeats(spark, sparse):
    df, _, _ = sparse
    marked = descent.with_target(df, F.col("label") == 1, 0.0)
    run = lambda d: descent.fit_margin(d, 12, logistic(), descent.Descent(0.05, None, 8))
    a, b = run(marked.repartition(1)), run(marked.repartition(8))
    assert a.losses[-1][1] < a.losses[0][1] and a.weights == pytest.approx(b.weights)


def test_ridge_penalty_differs_from_scalar_norm():
    w = np.array([3.0, 4.0])
    assert descent.ridge_penalty(0.5)(w, 1.0, np.zeros(2))[0] == 1 + 0.5 * 25
    assert descent.scalar_norm_penalty(0.5)(w, 1.0, np.zeros(2))[1].tolist() == [5.0, 5.0]


def test_a_pass_shuffles_only_sums(spark, sparse):
    df, _, _ = sparse
    kept = descent.arranged(descent.with_target(df, F.col("label") == 1, 0.0)).persist()
    kept.count()
    plan = descent.pass_sums(kept, descent.weight_table(spark, np.full(12, 0.1)), logistic())
    top = plan._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert top.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(pos" in top and "Sort" not in top
    kept.unpersist()


def test_weight_bound(spark):
    with pytest.raises(ValueError, match="weights"):
        descent._check_width(descent.MAX_WEIGHTS + 1)


def test_positive_share_counts_all_documents_below(spark):
    all_docs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "doc_id string")
    features = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0)], "doc_id string, label int")
    row = positive_share(all_docs, features, F.col("label") == 1).first()
    assert (row["pr"], row["nr"]) == (0.25, 0.75)


def test_trips(spark, tmp_path):
    lines = []
    for i in range(400):
        minutes, miles = 2 + i % 50, 1 + i % 40
        lines.append(f"a,b,c,{i},{minutes * 60},{miles},e,f,g,h,i,{3 + miles},0.5,j,k,5,{4 + 2 * miles + 0.1 * minutes}")
    lines.append("bad,line")
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    fit, measured = trips.run_trips(df)
    row = measured.first()
    assert len(fit.losses) > 1 and fit.losses[-1][1] < fit.losses[0][1] and 0 < row["n"] < 400
    batch_fit, batch_measured = trips.run_trips(df, batch=50, passes=30)
    assert len(batch_fit.losses) == 30 and batch_measured.first()["mse"] > 0


def test_document_flow_from_lines(spark):
    words = {"AU": "court judge appeal ruling", "": "river mountain history town"}
    tagged = [(f'<doc id="{p}{i}" url="http://x/{i}" title="t">{w} case{i % 7} </doc>',) for p, w in words.items() for i in range(30)]
    promos = [(f"best offer buy cheap {i % 5},http://shop/{i}",) for i in range(30)]
    docs = documents.documents_from_lines(
        spark.createDataFrame(tagged, "value string"), spark.createDataFrame(promos, "value string"))
    assert {r["label"]: r["count"] for r in docs.groupBy("label").count().collect()} == {0: 30, 1: 30, 2: 30}
    phases = Phases()
    # ids of promotion lines follow the layout, so the rows are fixed before they are split
    docs = docs.persist()
    out = documents.run_documents(docs, docs, documents.PRESETS["logistic_full"], size=60, passes=40, phases=phases)
    scores = {r["task"]: r["accuracy"] for r in out.collect()}
    assert set(scores) == {"first_class", "second_class", "second_without_first"}
    assert [r["phase"] for r in phases.table(spark).collect()] == ["train", "test", "total"]
    judged = documents.run_documents(docs, docs, "multinomial", size=60).collect()
    assert {r["class"] for r in judged} == {0, 1, 2}
    docs.unpersist()


def test_sparse_vectors_match_long_features(spark):
    df = spark.createDataFrame([("x", ["a", "a", "b", "z"]), ("y", ["b"]), ("e", [])], "doc_id string, words array<string>")
    out = {r["doc_id"]: r["features"] for r in mlfit.sparse_vectors(df, ["a", "b"], [2.0, -1.0]).collect()}
    assert out["x"].toArray().tolist() == [0.5, -0.25] and out["y"].toArray().tolist() == [0.0, -1.0] and "e" not in out


def test_evaluate(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (0.0, 0.0)], "label double, pred double")
    assert mlfit.evaluate(df) == {"f_score": pytest.approx(2 / 3), "accuracy": pytest.approx(2 / 3)}
