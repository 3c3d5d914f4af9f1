"""Every query with SQL equals DuckDB; the others run and keep their rows."""

import pytest

from tallyloom.catalog import QUERIES, SQL
from tests.parity import compare, duck


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["multinomial_lr", "random_forest"])
def test_library_models_score_every_row(spark, folder, name):
    out = QUERIES[name](spark, folder)
    assert out.count() == spark.read.parquet(f"{folder}/embeddings.parquet").count()
    assert out.where("pred is null or pred not between 0 and 9").count() == 0


@pytest.mark.parametrize("name", ["flow_logistic_full_quick", "flow_svm_batches_quick", "flow_weighted_svm", "flow_forest"])
def test_flows_measure_their_tasks(spark, folder, name):
    rows = QUERIES[name](spark, folder).collect()
    assert len(rows) == {"flow_weighted_svm": 1, "flow_forest": 2}.get(name, 3)
    assert all(r["tp"] + r["fn"] + r["tn"] + r["fp"] > 0 for r in rows)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["doc_id", "pos", "value"] and df.limit(1).count() == 1
