"""The forest of ``forest.py`` over sparse rows: positions and values of what is not zero.

The trees are those ``forest.fit_forest`` grows on the same rows written out, but a row costs its own entries, not one
cell for every feature.  Zeros are counted by difference: a node's rows less those with an entry.  A level reads the
rows once and explodes only the entries its nodes ask for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.hashing import uniform
from tallyloom.plans.forest import MAX_NODES, POISSON, SHARE, _cell, _features_of, _first_cells, _splits_of
from tallyloom.session import settled

@dataclass(frozen=True)
class SparseForest:
    """``splits``: (tree, node, pos, cut, low, span, cell), rows whose value is in that cell or above go right; the rest as in ``Forest``."""

    classes: list
    splits: list[tuple[int, int, int, int, float, float, int]]
    leaves: list[tuple[int, int, list[int]]]
    trees: int
    depth: int


def _value(pos: Column) -> Column:
    return F.coalesce(F.get("v", F.array_position("at", pos).cast("int") - 1), F.lit(0.0))


def _walked(rows: DataFrame, forest: SparseForest, levels: int) -> DataFrame:
    """Rows ``tree`` with their ``node`` after so many levels; rows at nodes without a split stay."""
    if not forest.splits or not levels:
        return rows.withColumn("node", F.lit(1))
    # one row of arrays by tree and node: a step looks up its split, whatever the number of levels
    size = 1 << forest.depth
    table: list[list] = [[None] * (forest.trees * size) for _ in range(4)]
    for tree, node, pos, _, *cell in forest.splits:
        for column, x in zip(table, (pos, *cell)):
            column[tree * size + node] = x
    held = F.broadcast(rows.sparkSession.createDataFrame([tuple(table)], "_pos array<int>, _low array<double>, _span array<double>, _cell array<int>"))

    def step(node: Column, _: Column) -> Column:
        pos, low, span, cell = (F.get(c, F.col("tree") * size + node) for c in ("_pos", "_low", "_span", "_cell"))
        right = _cell(_value(pos), low, span) >= cell
        return F.when(pos.isNull(), node).otherwise(node * 2 + right.cast("int"))

    # a node of the last level has no split and no place in the arrays: the steps end there
    return rows.crossJoin(held).withColumn(
        "node", F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), step)).drop("_pos", "_low", "_span", "_cell")


def _cut_points(base: DataFrame, total: int, bins: int) -> DataFrame:
    """``pos, low, span, cuts, zero`` of every position with an entry; ``zero`` is the bin of rows without one."""
    entries = base.select(F.explode(F.arrays_zip("at", "v")).alias("e")).select("e.at", "e.v").withColumnRenamed("at", "pos")
    sound = F.when(~F.isnan("v"), F.col("v"))
    gaps = F.col("n") < total
    low, high = (F.when(gaps, f(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0))).otherwise(F.coalesce(F.col(c), F.lit(0.0)))
                 for f, c in ((F.least, "lo"), (F.greatest, "hi")))
    spans = settled(entries.groupBy("pos").agg(F.count("*").alias("n"), F.min(sound).alias("lo"), F.max(sound).alias("hi")).select(
        "pos", "n", low.alias("low"), (high - low).alias("span")))
    # a row per feature: as bounded as the dictionary is
    cells = entries.join(F.broadcast(spans), "pos").groupBy("pos", _cell(F.col("v"), F.col("low"), F.col("span")).alias("cell")).agg(F.count("*").alias("n"))
    zeros = spans.where(gaps).select("pos", _cell(F.lit(0.0), F.col("low"), F.col("span")).alias("cell"), (F.lit(total) - F.col("n")).alias("n"))
    firsts = _first_cells(cells.unionByName(zeros).groupBy("pos", "cell").agg(F.sum("n").alias("n")), bins)
    cuts = firsts.select("pos", F.slice("firsts", F.lit(2), F.size("firsts")).alias("cuts"))
    zero = _bin(_cell(F.lit(0.0), F.col("low"), F.col("span")))
    return settled(spans.join(cuts, "pos").select("pos", "low", "span", "cuts", zero.alias("zero")))


def _bin(cell: Column) -> Column:
    return F.size(F.filter("cuts", lambda c: c <= cell))


def fit_sparse_forest(rows: DataFrame, key: str, width: int, label: str = "label", at: str = "at", values: str = "values",
                      trees: int = 3, depth: int = 4, bins: int = 32, seed: int = 13) -> SparseForest:
    """Trees over ``width`` features; a row holds positions ``at``, each once, and ``values`` as long.

    Rows without a label or positions are left out; an empty list is a row of zeros.
    """
    if trees << (depth + 1) > MAX_NODES:
        raise ValueError(f"{trees} trees of depth {depth} exceed {MAX_NODES} nodes")
    spark = rows.sparkSession
    known = rows.where(F.col(label).isNotNull() & F.col(at).isNotNull() & F.col(values).isNotNull())
    base = settled(known.select(F.col(key).alias("key"), F.col(label).alias("label"),
                                F.col(at).cast("array<int>").alias("at"), F.col(values).cast("array<double>").alias("v")))
    classes = sorted(r[0] for r in base.select("label").distinct().collect())
    forest = SparseForest(classes, [], [], trees, depth)
    if not classes or not width:
        return forest
    cuts = F.broadcast(_cut_points(base, base.count(), bins))
    drawn = uniform("key", "tree", seed=seed)
    weight = sum((drawn >= F.lit(c)).cast("bigint") for c in POISSON)
    place = F.array_position(F.array(*map(F.lit, classes)), F.col("label")).cast("int")
    roots = base.select(
        "key", place.alias("class"), "at", "v", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
    ).select("tree", "class", "at", "v", weight.alias("w")).where("w > 0")
    counts = [f"n{i}" for i in range(len(classes))]
    sums = [F.sum(F.when(F.col("class") == i + 1, F.col("w")).otherwise(0)).alias(c) for i, c in enumerate(counts)]
    open_nodes = [(t, 1) for t in range(trees)]
    for level in range(depth):
        if not open_nodes:
            break
        asked = spark.createDataFrame([(t, n, _features_of(t, n, width, seed)) for t, n in open_nodes], "tree int, node int, asked array<int>")
        state = _walked(roots, forest, level).join(F.broadcast(asked), ["tree", "node"])
        found = [tuple(r) for r in _best_splits(state, asked, cuts, counts, sums).collect()]  # at most one row per open node
        forest.splits.extend(found)
        open_nodes = [(s[0], 2 * s[1] + side) for s in found for side in (0, 1)]
    for r in _walked(roots, forest, depth).groupBy("tree", "node").agg(*sums).collect():
        held = [r[c] for c in counts]
        forest.leaves.append((r["tree"], r["node"], [n * SHARE // sum(held) for n in held]))
    return forest


def _best_splits(state: DataFrame, asked: DataFrame, cuts: DataFrame, counts: list[str], sums: list[Column]) -> DataFrame:
    entries = state.select("tree", "node", "class", "w", "at", "v", F.explode(F.array_intersect("at", "asked")).alias("pos"))
    met = settled(
        entries.select("tree", "node", "class", "w", "pos", _value(F.col("pos")).alias("x")).join(cuts, "pos")
        .groupBy("tree", "node", "pos", _bin(_cell(F.col("x"), F.col("low"), F.col("span"))).alias("cut")).agg(*sums))
    # tables of histograms from here on: nodes by asked features by bins
    key = ["tree", "node", "pos"]
    totals = state.groupBy("tree", "node").agg(*sums)
    whole = asked.select("tree", "node", F.explode("asked").alias("pos")).join(F.broadcast(totals), ["tree", "node"]).join(
        cuts, "pos").select(*key, F.col("zero").alias("cut"), *counts)
    less = met.join(cuts, "pos").select(*key, F.col("zero").alias("cut"), *((-F.col(c)).alias(c) for c in counts))
    histogram = met.unionByName(whole).unionByName(less).groupBy(*key, "cut").agg(*(F.sum(c).alias(c) for c in counts))
    held = histogram.where(" + ".join(counts) + " > 0")
    found = _splits_of(held, counts).join(cuts, "pos")
    return found.select("tree", "node", "pos", "cut", "low", "span", F.get("cuts", F.col("cut")).alias("cell"))


def predict_sparse_forest(rows: DataFrame, forest: SparseForest, keep: list[str], at: str = "at", values: str = "values") -> DataFrame:
    """``keep`` and ``pred``: the class with the largest sum of leaf shares, ties to the smaller; null without positions."""
    if not forest.leaves:
        return rows.select(*keep, F.lit(None).cast("double").alias("pred"))
    kept = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keep)]
    base = rows.select(F.monotonically_increasing_id().alias("_row"), *kept, F.col(at).cast("array<int>").alias("at"),
                       F.col(values).cast("array<double>").alias("v"))
    walked = _walked(base.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1)))), forest, forest.depth)
    leaves = F.broadcast(rows.sparkSession.createDataFrame(forest.leaves, "tree int, node int, shares array<bigint>"))
    sums = F.array(*(F.coalesce(F.sum(F.get("shares", F.lit(i))), F.lit(0)) for i in range(len(forest.classes))))
    names = [f"_k{i}" for i in range(len(keep))]
    voted = walked.withColumn("_sound", F.col("at").isNotNull() & F.col("v").isNotNull()).join(leaves, ["tree", "node"], "left").groupBy(
        "_row", *names).agg(F.max("_sound").alias("_sound"), sums.alias("_sums"))
    best = F.get(F.array(*map(F.lit, forest.classes)), (F.array_position("_sums", F.array_max("_sums")) - 1).cast("int"))
    return voted.select(*(F.col(n).alias(k) for n, k in zip(names, keep)), F.when(F.col("_sound"), best).alias("pred"))
