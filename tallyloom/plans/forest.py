"""Random forest grown level by level from split histograms.

Feature values are counted in fine cells of equal width, and neighbouring cells are joined into bins that hold about
the same number of rows.  Each tree weighs rows by a keyed Poisson draw.  A level is one ``groupBy`` over
(tree, node, feature, bin) for all trees at once, with class weights as integers, so the best split (gini, ties to the
first feature and lowest bin) does not depend on the layout.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.hashing import uniform
from tallyloom.session import settled

# shares of Poisson(1) up to 0, 1, 2, 3, 4, 5
POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183)
CELLS = 1024
SHARE = 1_000_000_000  # class shares of a leaf are whole billionths
MAX_NODES, MAX_CUTS = 1 << 16, 1 << 20  # what a forest may hold on the driver: nodes, and cut points of all features


@dataclass(frozen=True)
class Forest:
    """``splits``: (tree, node, pos, cut), left child 2 node, right child 2 node + 1; ``leaves``: (tree, node, shares by class)."""

    ranges: list[tuple[float, float]]
    cuts: list[list[int]]
    classes: list
    splits: list[tuple[int, int, int, int]]
    leaves: list[tuple[int, int, list[int]]]
    trees: int
    depth: int

    def bins(self, vector: Column) -> Column:
        """The bin of every component; null and NaN count as lowest."""
        low, span = (F.array(*map(F.lit, side)) for side in zip(*((lo, hi - lo) for lo, hi in self.ranges)))
        cuts = F.array(*(F.array(*map(F.lit, c)) for c in self.cuts))

        def bin_of(value: Column, i: Column) -> Column:
            cell = _cell(value, F.get(low, i), F.get(span, i))
            return F.size(F.filter(F.get(cuts, i), lambda c: c <= cell))

        return F.transform(vector, bin_of)


def _cell(value: Column, low: Column, span: Column) -> Column:
    inside = F.floor((value - low) / span * F.lit(float(CELLS)))
    usable = value.isNotNull() & ~F.isnan(value) & (span > 0)
    return F.when(usable, F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), inside))).otherwise(0).cast("int")


def _cut_points(base: DataFrame, bins: int) -> tuple[list[tuple[float, float]], list[list[int]]]:
    values = base.select(F.posexplode("x").alias("pos", "v"))
    sound = values.where(F.col("v").isNotNull() & ~F.isnan("v"))
    found = {r["pos"]: (r["lo"], r["hi"]) for r in sound.groupBy("pos").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    width = base.agg(F.max(F.size("x"))).first()[0] or 0
    if width * bins > MAX_CUTS:
        raise ValueError(f"{width} features by {bins} bins exceed {MAX_CUTS} cut points")
    ranges = [found.get(p, (0.0, 0.0)) for p in range(width)]
    if not width:
        return [], []
    low, span = (F.array(*map(F.lit, side)) for side in zip(*((lo, hi - lo) for lo, hi in ranges)))
    cells = values.groupBy("pos", _cell(F.col("v"), F.get(low, F.col("pos")), F.get(span, F.col("pos"))).alias("cell")).agg(F.count("*").alias("n"))
    cuts = {r["pos"]: r["firsts"][1:] for r in _first_cells(cells, bins).collect()}
    return ranges, [cuts.get(p) or [CELLS] for p in range(width)]


def _first_cells(cells: DataFrame, bins: int) -> DataFrame:
    """``pos, firsts``: the first cell of every bin, from the rows ``n`` of each cell."""
    each = Window.partitionBy("pos")
    upto = F.sum("n").over(each.orderBy("cell"))
    # at most CELLS rows per feature
    binned = cells.withColumn("bin", F.floor((upto - F.col("n")) * bins / F.sum("n").over(each)))
    return binned.groupBy("pos", "bin").agg(F.min("cell").alias("first")).groupBy("pos").agg(F.sort_array(F.collect_list("first")).alias("firsts"))


def _features_of(tree: int, node: int, width: int, seed: int) -> list[int]:
    """The square root of all features, those with the lowest keyed draws."""
    draws = ((int(hashlib.md5(f"{tree}:{node}:{p}:{seed}f".encode()).hexdigest()[:13], 16), p) for p in range(width))
    return sorted(p for _, p in sorted(draws)[: math.ceil(math.sqrt(width))])


def fit_forest(rows: DataFrame, key: str, label: str = "label", vector: str = "features", trees: int = 3, depth: int = 4,
               bins: int = 32, seed: int = 13) -> Forest:
    """Trees over ``vector`` (an array of numbers of one length).

    Rows without a label or vector are left out; rows that repeat a key share their draws and all count.  An
    empty table gives a forest without classes, which predicts null.
    """
    if trees << (depth + 1) > MAX_NODES:
        raise ValueError(f"{trees} trees of depth {depth} exceed {MAX_NODES} nodes")
    known = rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    base = settled(known.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x")))
    ranges, cuts = _cut_points(base, bins)
    classes = sorted(r[0] for r in base.select("label").distinct().collect())
    forest = Forest(ranges, cuts, classes, [], [], trees, depth)
    if not classes or not ranges:
        return forest
    spark = rows.sparkSession
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    drawn = uniform("key", "tree", seed=seed)
    weight = sum((drawn >= F.lit(c)).cast("bigint") for c in POISSON)
    place = F.array_position(F.array(*map(F.lit, classes)), F.col("label")).cast("int")
    state = settled(
        base.select("key", place.alias("class"), forest.bins(F.col("x")).alias("bins"), tree)
        .select("tree", F.lit(1).alias("node"), "class", "bins", weight.alias("w")).where("w > 0"))
    counts = [f"n{i}" for i in range(len(classes))]
    open_nodes = [(t, 1) for t in range(trees)]
    for _ in range(depth):
        if not open_nodes:
            break
        asked = [(t, n, _features_of(t, n, len(ranges), seed)) for t, n in open_nodes]
        best = _best_splits(state.join(F.broadcast(spark.createDataFrame(asked, "tree int, node int, asked array<int>")), ["tree", "node"]), counts)
        found = [tuple(r) for r in best.collect()]  # at most one row per open node
        forest.splits.extend(found)
        open_nodes = [(t, 2 * n + side) for t, n, _, _ in found for side in (0, 1)]
        if found:
            state = settled(_moved(state, found))
    sums = [F.sum(F.when(F.col("class") == i + 1, F.col("w")).otherwise(0)).alias(c) for i, c in enumerate(counts)]
    for r in state.groupBy("tree", "node").agg(*sums).collect():
        held = [r[c] for c in counts]
        forest.leaves.append((r["tree"], r["node"], [n * SHARE // sum(held) for n in held]))
    return forest


def _moved(state: DataFrame, splits: list[tuple[int, int, int, int]]) -> DataFrame:
    """Rows at the child their bin sends them to; rows at nodes without a split stay."""
    table = F.broadcast(state.sparkSession.createDataFrame(splits, "tree int, node int, pos int, cut int"))
    below = F.col("node") * 2 + (F.get("bins", F.col("pos")) > F.col("cut")).cast("int")
    return state.join(table, ["tree", "node"], "left").withColumn(
        "node", F.when(F.col("pos").isNull(), F.col("node")).otherwise(below)).drop("pos", "cut")


def _best_splits(asked: DataFrame, counts: list[str]) -> DataFrame:
    sums = [F.sum(F.when(F.col("class") == i + 1, F.col("w")).otherwise(0)).alias(c) for i, c in enumerate(counts)]
    histogram = (
        asked.select("tree", "node", "class", "w", "bins", F.explode("asked").alias("pos"))
        .groupBy("tree", "node", "pos", F.get("bins", F.col("pos")).alias("cut")).agg(*sums))
    return _splits_of(histogram, counts)


def _splits_of(histogram: DataFrame, counts: list[str]) -> DataFrame:
    # windows over histograms: at most as many rows as a feature has bins
    feature = Window.partitionBy("tree", "node", "pos")
    left = histogram.select(
        "tree", "node", "pos", "cut", F.array(*(F.sum(c).over(feature.orderBy("cut")) for c in counts)).alias("l"),
        F.array(*(F.sum(c).over(feature) for c in counts)).alias("all"))
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, n: s + n)
    squares = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, n: s + n * n)
    purity = lambda a: squares(a).cast("double") / total(a).cast("double")
    sides = left.withColumn("r", F.zip_with("all", "l", lambda a, b: a - b)).where(total(F.col("r")) > 0)
    scored = sides.withColumn("score", purity(F.col("l")) + purity(F.col("r"))).where(F.col("score") > purity(F.col("all")))
    place = F.row_number().over(Window.partitionBy("tree", "node").orderBy(F.desc("score"), "pos", "cut"))
    return scored.withColumn("_p", place).where("_p = 1").select("tree", "node", "pos", "cut")


def predict_forest(rows: DataFrame, forest: Forest, keep: list[str], vector: str = "features") -> DataFrame:
    """``keep`` and ``pred``: the class with the largest sum of leaf shares, ties to the smaller; null without a vector."""
    if not forest.leaves:
        return rows.select(*keep, F.lit(None).cast("double").alias("pred"))
    spark = rows.sparkSession
    base = settled(rows.select(F.monotonically_increasing_id().alias("_row"), F.struct(*keep).alias("_kept"),
                               forest.bins(F.col(vector).cast("array<double>")).alias("bins")))
    walked = base.select("_row", "_kept", "bins", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree"), F.lit(1).alias("node"))
    for _ in range(forest.depth if forest.splits else 0):
        walked = _moved(walked, forest.splits)
    leaves = F.broadcast(spark.createDataFrame(forest.leaves, "tree int, node int, shares array<bigint>"))
    sums = F.array(*(F.coalesce(F.sum(F.get("shares", F.lit(i))), F.lit(0)) for i in range(len(forest.classes))))
    voted = walked.join(leaves, ["tree", "node"], "left").groupBy("_row").agg(
        F.first("_kept").alias("_kept"), F.max(F.col("bins").isNotNull()).alias("_sound"), sums.alias("_sums"))
    best = F.get(F.array(*map(F.lit, forest.classes)), (F.array_position("_sums", F.array_max("_sums")) - 1).cast("int"))
    return voted.select("_kept.*", F.when(F.col("_sound"), best).alias("pred"))
