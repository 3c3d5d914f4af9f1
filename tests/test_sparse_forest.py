"""The forest over sparse rows against the one over the same rows written out."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyloom.plans import documents, forest, mlfit, sparse_forest

WIDTH = 30


def made(spark, n=600, seed=5):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        held = {p: draw.choice([0.5, 1.0, -2.0, draw.random()]) for p in sorted(draw.sample(range(WIDTH - 2), draw.randrange(0, 12)))}
        held[WIDTH - 2] = 1.0 + i % 3  # in every row; the last feature is in none
        label = None if i % 50 == 7 else float((3 in held) + (held.get(5, 0) > 0.4))
        rows.append((i // 2, label, list(held), [float(x) for x in held.values()], [float(held.get(p, 0)) for p in range(WIDTH)]))
    return spark.createDataFrame(rows, "id bigint, label double, at array<int>, values array<double>, features array<double>")


def test_grows_the_trees_of_the_written_out_rows(spark):
    table = made(spark)
    dense = forest.fit_forest(table, "id", trees=4, depth=4)
    sparse = sparse_forest.fit_sparse_forest(table.repartition(7), "id", WIDTH, trees=4, depth=4)
    assert sorted(s[:4] for s in sparse.splits) == sorted(dense.splits) and len(dense.splits) > 10
    assert sorted(sparse.leaves) == sorted(dense.leaves)
    keep = ["id", "label"]
    want = forest.predict_forest(table, dense, keep).collect()
    got = sparse_forest.predict_sparse_forest(table, sparse, keep).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 600


@pytest.mark.parametrize("rows", [[], [(1, None, [0], [1.0])], [(1, 1.0, None, None)], [(1, 1.0, [], []), (2, 0.0, [], [])]])
def test_nothing_to_split(spark, rows):
    table = spark.createDataFrame(rows, "id bigint, label double, at array<int>, values array<double>")
    fitted = sparse_forest.fit_sparse_forest(table, "id", 4)
    found = sparse_forest.predict_sparse_forest(table, fitted, ["id"]).collect()
    assert fitted.splits == [] and len(found) == len(rows)


def test_entries_of_dense_and_sparse_vectors(spark):
    table = spark.createDataFrame([(1, Vectors.sparse(9, [2, 5], [1.0, 0.0])), (2, Vectors.dense([0.0, 3.0, 0.0])), (3, Vectors.sparse(9, [], []))], ["id", "features"])
    got = {r["id"]: (r["at"], r["values"]) for r in mlfit.entries(table).collect()}
    assert got == {1: ([2], [1.0]), 2: ([1], [3.0]), 3: ([], [])}


def test_flow_keeps_no_row_of_all_bins(spark, monkeypatch):
    """The flow never hands its documents to the library's forest, which writes a cell for every word of the dictionary."""
    def refused(*_, **__):
        raise AssertionError("written out")

    monkeypatch.setattr(mlfit, "fit_forest", refused)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("label"), F.array(
        F.lit("every"), F.concat(F.lit("class"), F.col("id") % 3), F.concat(F.lit("word"), F.col("id") % 17)).alias("words"))
    rows = documents.run_documents(docs.where("doc_id % 5 > 0"), docs.where("doc_id % 5 = 0"), "forest", size=50).collect()
    assert len(rows) == 2 and all(r["tp"] + r["fn"] + r["tn"] + r["fp"] > 0 for r in rows)
