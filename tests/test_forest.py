"""The level-wise forest on small tables."""

import pytest

from tallyloom.plans import forest

SCHEMA = "id bigint, label double, features array<double>, tree string, node string, bins string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def test_finds_a_corner_and_ignores_layout(spark):
    rows = [(i, float(i % 20 >= 10 and i % 7 >= 3), [float(i % 20), float(i % 7), 1.0]) for i in range(700)]
    table = made(spark, rows)
    fitted = forest.fit_forest(table, "id", trees=5, depth=5)
    again = forest.fit_forest(table.repartition(13, "label"), "id", trees=5, depth=5)
    assert fitted.splits == again.splits and sorted(fitted.leaves) == sorted(again.leaves)
    scored = forest.predict_forest(table, fitted, ["id", "label", "tree", "bins"]).collect()
    assert len(scored) == 700 and sum(r["label"] == r["pred"] for r in scored) >= 690
    assert all(sum(s) <= forest.SHARE for _, _, s in fitted.leaves)


def test_splits_keep_rows_on_both_sides(spark):
    rows = [(i, float(i % 3), [float(i % 5), float(i)]) for i in range(200)]
    fitted = forest.fit_forest(made(spark, rows), "id", trees=2, depth=3)
    parents = {(t, n) for t, n, _, _ in fitted.splits}
    ends = {(t, n) for t, n, _ in fitted.leaves}
    assert not parents & ends
    assert all((t, 2 * n + side) in parents | ends for t, n in parents for side in (0, 1))


@pytest.mark.parametrize("rows", [
    [], [(1, None, [1.0])], [(1, 1.0, None), (2, 0.0, None)],
])
def test_nothing_to_learn_from(spark, rows):
    table = made(spark, rows)
    fitted = forest.fit_forest(table, "id")
    assert fitted.splits == [] and all(r["pred"] is None for r in forest.predict_forest(table, fitted, ["id"]).collect())


def test_gaps_one_class_and_repeated_rows(spark):
    rows = [(1, 2.0, [float("nan"), None, 3.0])] * 40 + [(2, 2.0, [0.0, 1.0, 3.0])] * 40 + [(3, None, [1.0, 1.0, 1.0]), (4, 2.0, None)]
    table = made(spark, rows)
    fitted = forest.fit_forest(table, "id", trees=8)
    assert fitted.splits == []  # one class: nothing to gain
    found = forest.predict_forest(table, fitted, ["id"]).collect()
    assert len(found) == len(rows) and {r["pred"] for r in found if r["id"] != 4} == {2.0}
    assert [r["pred"] for r in found if r["id"] == 4] == [None]


def test_too_large_a_forest_is_refused(spark):
    with pytest.raises(ValueError):
        forest.fit_forest(made(spark, []), "id", trees=100, depth=12)
