"""Adaptive-rate gradient descent where Spark sums and the driver steps.

The rule of every fit: move the weights by rate x gradient, then raise the rate
by 5 % if the loss fell (the first pass compares with 0) or halve it, and stop
when the loss changed by no more than the tolerance.

* Squared loss needs one job for the whole fit: loss and gradient of *any*
  weights follow from the sums of products X'X, X'y, y'y.
* Logistic and hinge losses need one pass per step over features packed into
  blocks (``blocks.py``); models that learn from the same features share it, the
  weights (one double per dictionary word) go along, and only sums are shuffled.
* Mini-batches are drawn for all passes in one scan and fetched in bounded lots.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyloom.functions.hashing import fast_uniform, uniform
from tallyloom.functions.losses import RowLoss
from tallyloom.operators.lookup import small
from tallyloom.plans.blocks import Batches, Side, packed, pass_over
from tallyloom.session import settled

MAX_WEIGHTS = 2_000_000


@dataclass
class Descent:
    """Step rule shared by all fits."""

    rate: float
    tolerance: float | None
    passes: int
    record_last: bool = True  # record the loss of the pass that stops the fit

    def steps(self, weights: np.ndarray) -> Generator[tuple[int, np.ndarray], tuple[float, np.ndarray] | None, "Fit"]:
        """Yields pass and weights, takes loss and gradient there (None for an empty batch), returns the fit."""
        rate, before, fit = self.rate, 0.0, Fit(weights)
        for i in range(self.passes):
            result = yield i, weights
            if result is None:  # an empty batch: nothing to learn from
                continue
            loss, gradient = result
            weights = weights - rate * gradient
            fit.weights = weights
            rate = rate * (1.05 if loss < before else 0.5)
            settled = self.tolerance is not None and abs(loss - before) <= self.tolerance
            if self.record_last or not settled:
                fit.losses.append((i + 1, float(loss)))
            if settled:
                fit.stopped_at = i + 1
                break
            before = loss
        return fit

    def run(self, weights: np.ndarray, evaluate: Callable[[int, np.ndarray], tuple[float, np.ndarray] | None]) -> "Fit":
        return together([self], [weights], lambda asked: {i: evaluate(*asked[i]) for i in asked})[0]


def together(rules: Sequence[Descent], weights: Sequence[np.ndarray], evaluate: Callable) -> "list[Fit]":
    """Several descents in step: ``evaluate`` gets pass and weights of all that still run and answers for each."""
    runs = [rule.steps(w) for rule, w in zip(rules, weights)]
    fits: list[Fit | None] = [None] * len(runs)
    answers: dict[int, tuple | None] = dict.fromkeys(range(len(runs)))
    while answers:
        asked = {}
        for i, answer in answers.items():
            try:
                asked[i] = runs[i].send(answer)
            except StopIteration as done:
                fits[i] = done.value
        answers = evaluate(asked) if asked else {}
    return fits


@dataclass
class Fit:
    weights: np.ndarray
    losses: list[tuple[int, float]] = field(default_factory=list)
    stopped_at: int | None = None

    def weight_table(self, spark: SparkSession) -> DataFrame:
        return weight_table(spark, self.weights)

    def loss_table(self, spark: SparkSession) -> DataFrame:
        """Loss history as a table (one row per pass)."""
        return spark.createDataFrame(self.losses, "iteration int, loss double")


def weight_table(spark: SparkSession, weights: np.ndarray) -> DataFrame:
    frame = pd.DataFrame({"pos": np.arange(len(weights), dtype="int32"), "w": np.asarray(weights, dtype="float64")})
    return spark.createDataFrame(frame, "pos int, w double")


# -- squared loss ---------------------------------------------------------------

def product_sums(df: DataFrame, inputs: Sequence[str], target: str, by: Sequence[str] = ()) -> DataFrame:
    """``n``, ``yy``, ``y_i`` and ``x_i_j`` (upper half) sums, in one aggregate."""
    sums = [F.count("*").alias("n"), F.sum(F.col(target) * F.col(target)).alias("yy")]
    for i, a in enumerate(inputs):
        sums.append(F.sum(F.col(a) * F.col(target)).alias(f"y_{i}"))
        sums += [F.sum(F.col(a) * F.col(inputs[j])).alias(f"x_{i}_{j}") for j in range(i, len(inputs))]
    return df.groupBy(*by).agg(*sums)


class _Products:
    def __init__(self, row, width: int):
        self.n, self.yy = row["n"], row["yy"]
        self.xy = np.array([row[f"y_{i}"] for i in range(width)])
        self.xx = np.array([[row[f"x_{min(i, j)}_{max(i, j)}"] for j in range(width)] for i in range(width)])

    def at(self, w: np.ndarray, divisor: float) -> tuple[float, np.ndarray]:
        xxw = self.xx @ w
        return float(self.yy - 2 * w @ self.xy + w @ xxw) / divisor, (xxw - self.xy) / divisor


def fit_linear(df: DataFrame, inputs: Sequence[str], target: str, rate: float = 1e-4, tolerance: float | None = 0.1,
               passes: int = 300, start: float = 0.1) -> Fit:
    """Linear regression by full-batch descent: one Spark job for any number of passes.

    The loss of the pass that stops the fit is not recorded.
    """
    row = product_sums(df, inputs, target).first()
    if not row["n"]:
        raise ValueError("no rows to fit")
    products = _Products(row, len(inputs))
    rule = Descent(rate, tolerance, passes, record_last=False)
    return rule.run(np.full(len(inputs), start), lambda i, w: products.at(w, products.n))


def batch_members(df: DataFrame, key: str, size: int, total: int, passes: int, seed: int | str = 13,
                  fast: bool = True) -> DataFrame:
    """Rows with the passes whose batch they belong to (``_pass`` from 0); most rows belong to none.

    A row joins each batch with probability ``size / total``.  What is drawn is the gap to the next batch it
    joins (geometric, from draw number 0, 1, ...), so a row costs one draw more than it has batches, however
    many passes there are, and all passes are drawn in one scan.
    """
    if total <= size:
        return df.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    draw = fast_uniform if fast else uniform
    scale = F.lit(math.log1p(-size / total))

    def after(place: Column, number: Column) -> Column:
        gap = F.floor(F.log(1.0 - draw(F.col(key), number, seed=seed)) / scale)
        return (place + F.least(gap, F.lit(passes)) + 1).cast("int")

    first = df.withColumn("_first", after(F.lit(-1), F.lit(0))).where(F.col("_first") < passes)
    places = F.aggregate(
        F.sequence(F.lit(1), F.lit(passes)), F.array("_first"),
        lambda found, i: F.when(F.element_at(found, -1) >= passes, found).otherwise(
            F.concat(found, F.array(after(F.element_at(found, -1), i)))))
    return first.withColumn("_pass", F.explode(F.filter(places, lambda p: p < passes))).drop("_first")


def fit_linear_batches(df: DataFrame, inputs: Sequence[str], target: str, key: str, size: int = 50,
                       rate: float = 1e-4, passes: int = 300, start: float = 0.1, seed: int | str = 13,
                       fast: bool = True) -> Fit:
    """Linear regression by mini-batches, no early stop; sums are divided by the nominal batch size.

    One job sums the products of every batch; a pass without rows is skipped.
    """
    total = df.count()
    members = batch_members(df, key, size, total, passes, seed, fast)
    rows = {r["_pass"]: r for r in product_sums(members, inputs, target, ["_pass"]).collect()}
    batches = {i: _Products(r, len(inputs)) for i, r in rows.items()}
    rule = Descent(rate, None, passes)
    return rule.run(np.full(len(inputs), start), lambda i, w: batches[i].at(w, size) if i in batches else None)


# -- losses of a margin over sparse features -----------------------------------------

def with_target(features: DataFrame, label: Column, negative: float) -> DataFrame:
    """Add the target ``y``: 1 where the condition holds, else ``negative``."""
    return features.withColumn("y", F.when(label, F.lit(1.0)).otherwise(F.lit(float(negative))))


def arranged(features: DataFrame, key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Features partitioned and sorted by document, with one row per document marked."""
    ordered = features.select(F.col(key).alias("_doc"), "pos", "value", "y")
    ordered = ordered.repartition(partitions, "_doc") if partitions else ordered.repartition("_doc")
    first = F.row_number().over(Window.partitionBy("_doc").orderBy("pos")) == 1
    return ordered.withColumn("_head", first)


def pass_sums(features: DataFrame, weights: DataFrame, model: RowLoss, document: Sequence[str] = ("_doc",)) -> DataFrame:
    """Per dictionary position: gradient, and the share of loss and document count it carries.

    Summed over positions, ``loss`` and ``docs`` are those of the whole pass: each
    document's loss is counted on its first row.
    """
    margin = F.sum(F.col("value") * F.col("w")).over(Window.partitionBy(*document))
    scored = features.join(F.broadcast(weights), "pos").withColumn("_m", margin)
    y, m = F.col("y"), F.col("_m")
    return scored.groupBy("pos").agg(
        F.sum(model.slope(y, m) * F.col("value")).alias("gradient"),
        F.sum(F.when(F.col("_head"), model.loss(y, m)).otherwise(F.lit(0.0))).alias("loss"),
        F.count_if(F.col("_head")).alias("docs"),
    )


# Penalties: (weights, loss, gradient) -> (loss, gradient).

def scalar_norm_penalty(factor: float):
    """Adds the single number ``2 * factor * |w|`` to the loss and to every gradient component."""

    def apply(w, loss, gradient):
        extra = 2 * factor * float(np.linalg.norm(w))
        return loss + extra, gradient + extra

    return apply


def ridge_penalty(factor: float):
    """Adds ``factor * |w|^2`` to the loss and ``2 * factor * w`` to the gradient."""
    return lambda w, loss, gradient: (loss + factor * float(w @ w), gradient + 2 * factor * w)


def batch_norm_penalty(factor: float, size: int):
    """Divides by the nominal batch size; adds ``r/2 * |w|`` to the loss and ``r * w`` to the
    gradient, with ``r = 1 / (factor * size)``."""
    r = 1.0 / (factor * size)
    return lambda w, loss, gradient: (r * 0.5 * float(np.linalg.norm(w)) + loss / size, r * w + gradient / size)


def no_penalty(w, loss, gradient):
    return loss, gradient


def fit_margins(blocks: DataFrame, width: int, sides: Sequence[Side], rules: Sequence[Descent], penalty=no_penalty,
                start: float = 0.1, factors: np.ndarray | None = None) -> list[Fit]:
    """Full-batch descents over packed blocks, all in step: one pass over the data serves every model still running.

    With ``factors`` the features are the packed values times the factor of their position; only the driver multiplies.
    """
    _check_width(width)
    scale = np.ones(width) if factors is None else factors

    def evaluate(asked):
        sums = pass_over(blocks, [sides[i] for i in asked], [w * scale for _, w in asked.values()])
        return {i: penalty(w, loss, gradient * scale) if docs else None for (i, (_, w)), (loss, gradient, docs) in zip(asked.items(), sums)}

    return together(rules, [np.full(width, start)] * len(sides), evaluate)


def fit_margin(features: DataFrame, width: int, model: RowLoss, rule: Descent, penalty=no_penalty,
               start: float = 0.1, key: str = "doc_id") -> Fit:
    """Full-batch descent over features ``key, pos, value, y``: packed once, then one pass of sums per step."""
    blocks = packed(features, key, "y").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit_margins(blocks, width, [Side(model)], [rule], penalty, start)[0]
    finally:
        blocks.unpersist()


def fit_margin_batches(features: DataFrame, width: int, model: RowLoss, rule: Descent, size: int, total: int,
                       penalty=no_penalty, start: float = 0.1, key: str = "doc_id", seed: int | str = 13,
                       fast: bool = True, label: str = "y", target: float | None = None,
                       keys: DataFrame | None = None) -> Fit:
    """Mini-batch descent over features ``key, pos, value`` and a label (``y``: the target itself).

    ``keys``: the distinct keys of the features, where they are at hand.

    The batches of all passes are drawn in one scan, packed and kept (``size * passes`` documents); many passes
    are done on each lot that is fetched."""
    _check_width(width)
    # about size * passes rows: kept, counted and broadcast, so the features are not shuffled to find the batches
    keys = features.select(key).distinct() if keys is None else keys
    drawn = small(settled(batch_members(keys, key, size, total, rule.passes, seed, fast)))
    # kept as well: counting and packing read the drawn rows, not all features again
    members = settled(features.join(drawn, key).select(key, "_pass", "pos", "value", label))
    blocks = packed(members, key, label, "_pass").persist(StorageLevel.MEMORY_AND_DISK)
    side = Side(model, target)
    try:
        batches = Batches(blocks)

        def evaluate(i, w):
            sums = batches.sums(i, side, w)
            return penalty(w, sums[0], sums[1]) if sums and sums[2] else None

        return rule.run(np.full(width, start), evaluate)
    finally:
        blocks.unpersist()


def _check_width(width: int) -> None:
    if width > MAX_WEIGHTS:
        raise ValueError(f"{width} weights exceed the {MAX_WEIGHTS} that are broadcast and held on the driver")
