"""Packed blocks: nothing is lost in packing, one exchange a pass, descents in step, gaps instead of draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.losses import hinge, logistic, weighted_hinge
from tallyloom.plans import blocks, descent
from tallyloom.plans.blocks import Block, Side

RNG = np.random.default_rng(11)


@pytest.fixture(scope="module")
def data(spark):
    """60 documents of 1 to 20 words with labels 0 to 2, as rows and as arrays."""
    rows = [(f"d{d}", int(p), float(RNG.normal()), d % 3) for d in range(60) for p in sorted(RNG.choice(30, RNG.integers(1, 21), replace=False))]
    x, label = np.zeros((60, 30)), np.arange(60) % 3
    for d, p, v, _ in rows:
        x[int(d[1:]), p] = v
    return spark.createDataFrame(rows, "doc_id string, pos int, value double, label int"), x, label


def unpacked(packed):
    found = []
    for r in packed.collect():
        block = Block(r["ends"], r["label"], r["pos"], r["value"])
        for s, e, y in zip(block.starts, block.ends, block.label):
            found.append((r["pass"], y, tuple(sorted(zip(block.pos[s:e].tolist(), block.value[s:e].tolist())))))
    return sorted(found)


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 18])
def test_packing_keeps_documents_whole(data, monkeypatch, size):
    """Blocks of any size, also smaller than a document, hold the same documents; tasks run the packing as it is here."""
    import pyarrow as pa

    df, x, label = data
    rows = df.orderBy("doc_id", "pos").collect()
    monkeypatch.setattr(blocks, "BLOCK", size)
    batches = [pa.RecordBatch.from_pylist([{"pass": -1, "doc": r["doc_id"], "label": float(r["label"]), "pos": r["pos"], "value": r["value"]}
                                           for r in rows[at : at + 37]]) for at in range(0, len(rows), 37)]
    out = [b.to_pylist()[0] for b in blocks._pack(iter(batches))]
    docs = [(y, e - s) for r in out for s, e, y in zip(*(lambda b: (b.starts, b.ends, b.label))(Block(r["ends"], r["label"], r["pos"], r["value"])))]
    order = sorted(range(60), key=lambda d: f"d{d}")
    assert docs == [(label[d], np.count_nonzero(x[d])) for d in order]
    assert size > 1000 or len(out) > 5


def test_sums_of_a_pass(spark, data):
    df, x, label = data
    packed = blocks.packed(df.repartition(5))
    sides = [Side(logistic(), 1), Side(hinge(), 2), Side(weighted_hinge(0.3), 2, without=1)]
    weights = [RNG.normal(size=30) for _ in sides]
    for side, w, (loss, gradient, docs) in zip(sides, weights, blocks.pass_over(packed, sides, weights)):
        keep = np.ones(60, bool) if side.without is None else label != side.without
        y = np.where(label == side.target, 1.0, side.model.negative)
        want, slope = side.model.arrays(y, x @ w)
        assert loss == pytest.approx(want[keep].sum()) and gradient == pytest.approx(x[keep].T @ slope[keep]) and docs == keep.sum()


def test_shares_of_documents_and_factors_of_words(spark, data):
    """One value a document is kept once, positions take two bytes, and factors give what multiplied features give."""
    df, _, _ = data
    flat = df.withColumn("value", 1.0 / (F.substring("doc_id", 2, 9).cast("int") + 2))
    factors = RNG.normal(size=30)
    table = spark.createDataFrame([(p, float(f)) for p, f in enumerate(factors)], "pos int, f double")
    weighed = flat.join(table, "pos").withColumn("value", F.col("value") * F.col("f")).select(df.columns)
    packed, plain = blocks.packed(flat).persist(), blocks.packed(weighed).persist()
    words, bytes_of = df.count(), packed.agg(F.sum(F.octet_length("pos")), F.sum(F.octet_length("value"))).first()
    assert tuple(bytes_of) == (2 * words, 8 * 60) and unpacked(packed) == unpacked(blocks.packed(flat.repartition(3)))
    sides, rules = [Side(logistic(), 1), Side(hinge(), 2, without=1)], [descent.Descent(0.05, None, 6)] * 2
    penalty = descent.scalar_norm_penalty(1e-2)
    apart = descent.fit_margins(packed, 30, sides, rules, penalty, factors=factors)
    for a, b in zip(apart, descent.fit_margins(plain, 30, sides, rules, penalty)):
        assert np.allclose(a.weights, b.weights) and np.allclose(a.losses, b.losses)
    far = blocks.packed(flat.withColumn("pos", F.col("pos") + 70_000))
    assert unpacked(far) == [(p, y, tuple((i + 70_000, v) for i, v in w)) for p, y, w in unpacked(packed)]
    packed.unpersist(), plain.unpersist()


def test_array_losses_equal_columns(spark):
    y = np.array([0.0, 1.0, 1.0, 0.0, 1.0])
    m = np.array([-800.0, 800.0, 0.3, -0.2, 1.7])
    for model in (logistic(), hinge(), weighted_hinge(0.2)):
        targets = y if model.negative == 0 else 2 * y - 1
        df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(targets, m)], "y double, m double").coalesce(1)
        got = np.array([tuple(r) for r in df.select(model.loss(F.col("y"), F.col("m")), model.slope(F.col("y"), F.col("m"))).collect()]).T
        assert np.allclose(got, model.arrays(targets, m))


def test_one_exchange_of_sums(data):
    packed = blocks.packed(data[0]).persist()
    packed.count()
    plan = blocks.pass_plan(packed, [Side(logistic(), 1), Side(logistic(), 2)], [np.zeros(30)] * 2)
    top = plan._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert top.count("Exchange") == 1 and "slice" in top.split("Exchange")[1] and not any(w in top for w in ("Join", "Generate", "Sort"))
    packed.unpersist()


def test_fits_in_step_equal_fits_alone(data):
    df, _, _ = data
    packed = blocks.packed(df).persist()
    sides = [Side(logistic(), 1), Side(logistic(), 2), Side(logistic(), 2, without=1)]
    rules = [descent.Descent(0.05, 0.5, 20), descent.Descent(0.01, None, 3), descent.Descent(0.05, 1e-9, 12)]
    for side, rule, fit in zip(sides, rules, descent.fit_margins(packed, 30, sides, rules)):
        alone = descent.fit_margins(packed, 30, [side], [rule])[0]
        assert fit.losses == alone.losses and fit.stopped_at == alone.stopped_at and np.allclose(fit.weights, alone.weights)
    packed.unpersist()


@pytest.mark.parametrize("lot", [0, 400, 64 << 20])
def test_batches_wherever_they_are_summed(data, lot):
    """In tasks, in small lots and in one: the same sums; a batch without rows is none."""
    df, x, label = data
    members = df.withColumn("_pass", F.substring("doc_id", 2, 9).cast("int") % 7 * 2)
    batches = blocks.Batches(blocks.packed(members, batch="_pass").persist(), lot)
    w = RNG.normal(size=30)
    for i in range(14):
        got = batches.sums(i, Side(hinge(), 1), w)
        if i % 2:
            assert got is None
            continue
        keep = np.arange(60) % 7 * 2 == i
        want, slope = hinge().arrays(np.where(label == 1, 1.0, -1.0)[keep], x[keep] @ w)
        assert got[0] == pytest.approx(want.sum()) and got[1] == pytest.approx(x[keep].T @ slope) and got[2] == keep.sum()


@pytest.mark.parametrize("fast", [True, False])
def test_gaps_draw_every_batch_evenly(spark, fast):
    rows = spark.range(4000).select(F.col("id").alias("k"))
    members = descent.batch_members(rows, "k", 200, 4000, 60, fast=fast).groupBy("_pass").count().collect()
    counts = [r["count"] for r in members]
    assert sorted(r["_pass"] for r in members) == list(range(60))
    assert abs(np.mean(counts) - 200) < 6 and 9 < np.std(counts) < 19  # binomial: 13.8
    again = descent.batch_members(rows.repartition(3), "k", 200, 4000, 60, fast=fast)
    assert again.select("k", "_pass").distinct().count() == again.count() == sum(counts)


def test_a_batch_fit_reads_features_once(spark, data):
    """Beside the list of documents: what is drawn is kept, not read again to be counted and packed."""
    df, _, _ = data
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    features = df.withColumn("y", (F.col("label") == 1).cast("double")).mapInArrow(counted, "doc_id string, pos int, value double, label int, y double")
    rule, n = descent.Descent(0.05, None, 4), df.count()
    fits = []
    for keys, times in ((df.select("doc_id").distinct(), 1), (None, 2)):
        before = read.value
        fits.append(descent.fit_margin_batches(features, 30, logistic(), rule, 20, 60, keys=keys))
        assert read.value - before == times * n
    assert np.allclose(fits[0].weights, fits[1].weights) and len(fits[0].losses) == 4


def test_every_row_joins_if_the_batch_is_as_large(spark):
    rows = spark.range(5).select(F.col("id").alias("k"))
    assert descent.batch_members(rows, "k", 5, 5, 4).count() == 20


def test_no_features_at_all(spark, data):
    empty = data[0].where("false")
    fit = descent.fit_margins(blocks.packed(empty), 30, [Side(logistic(), 1)], [descent.Descent(0.1, None, 3)])[0]
    assert fit.losses == [] and np.allclose(fit.weights, 0.1)
