"""Merkle manifest against trees built in plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import merkle, queries_trees
from tallyloom.llm.places import placed
from tests.parity import compare, duck


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves, fanout):
    """Root and, per leaf, the steps (before, after) of its proof."""
    proofs, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for i, proof in enumerate(proofs):
            run = at[i] // fanout * fanout
            proof.append(("".join(leaves[run : at[i]]), "".join(leaves[at[i] + 1 : run + fanout])))
            at[i] //= fanout
        leaves = [h(*leaves[i : i + fanout]) for i in range(0, len(leaves), fanout)]
    return leaves[0], proofs


def plain_leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows, fanout):
    """``{key: (leaf, subroot, root, proof)}`` of rows (key, group, text); rows of one key in any order."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(((row[0] is not None, row[0] or 0, plain_leaf(row)), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: plain_tree([k[2] for k, _ in sorted(groups[g])], fanout) for g in names}
    root, high = plain_tree([low[g][0] for g in names], fanout)
    return sorted((repr((row[0], g)), k[2], low[g][0], root, low[g][1][i] + high[j])
                  for j, g in enumerate(names) for i, (k, row) in enumerate(sorted(groups[g])))


@pytest.mark.parametrize("fanout,levels", [(3, 1), (2, 1), (3, 2), (4, 1), (3, 6)])
def test_equals_plain_trees(spark, fanout, levels):
    """A group of most rows, ragged sizes, a null group, null and repeated keys, many groups."""
    draw = random.Random(fanout * 10 + levels)
    sizes = {"hot": 400, None: 28, "": 1, "é": 82, "z": 81, "𝄞": 10, "￿": 9} | {f"g{i}": draw.randrange(1, 6) for i in range(40)}
    rows = [(draw.choice([None, draw.randrange(60), draw.randrange(10_000)]), g, f"text {draw.random()}") for g, n in sizes.items() for _ in range(n)]
    rows += rows[:9]
    draw.shuffle(rows)
    table = spark.createDataFrame(rows, "k bigint, g string, t string").repartition(7)
    out = merkle.manifest(table, ["k", "g", "t"], "g", "k", fanout=fanout, levels=levels)
    out = out.withColumns({"f": merkle.folded(F.col("leaf"), F.col("proof")), "s": merkle.siblings(F.col("proof"))})
    got = out.collect()
    assert all(r["f"] == r["root"] for r in got)
    assert all(r["s"] == "".join(a + b for a, b in r["proof"]) for r in got)
    assert sorted((repr((r["k"], r["g"])), r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["proof"]]) for r in got) == plain_manifest(rows, fanout)


def test_any_change_shows(spark):
    rows = [(i, f"g{i % 3}", f"text {i}") for i in range(50)]
    kept = merkle.manifest(spark.createDataFrame(rows, "k bigint, g string, t string"), ["k", "g", "t"], "g", "k")
    root = {r["root"] for r in kept.select("root").collect()}
    assert len(root) == 1
    for other in (rows[:-1], [*rows, (50, "g0", "more")], [(0, "g0", "text 00"), *rows[1:]], [(0, "g1", "text 0"), *rows[1:]]):
        table = spark.createDataFrame(other, "k bigint, g string, t string")
        assert {r["root"] for r in merkle.manifest(table, ["k", "g", "t"], "g", "k").select("root").collect()} != root


def test_places(spark):
    rows = [("a" if i % 3 else None, i * 7919 % 1000) for i in range(1000)]
    got = placed(spark.createDataFrame(rows, "g string, o int").repartition(5), ["g"], ["o"]).collect()
    for g in ("a", None):
        mine = sorted((r["o"], r["pos"]) for r in got if r["g"] == g)
        assert [p for _, p in mine] == list(range(len(mine))) and {r["n"] for r in got if r["g"] == g} == {len(mine)}


def test_query_equals_sql(spark, odd, empty, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing columns; then no rows at all."""
    for name, table in (("odd", odd), ("empty", empty)):
        folder = str(tmp_path / name)
        table.coalesce(1).write.parquet(f"{folder}/documents.parquet")
        con = duck(str(tmp_path / "none"))
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
        out = queries_trees.op11_merkle_manifest(spark, folder)
        assert compare(out, con, queries_trees._SQL) == [] and out.count() == table.count()
