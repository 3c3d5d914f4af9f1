"""Multinomial regression over packed blocks: limited-memory quasi-Newton steps on sums of loss and gradient.

The objective is the mean log loss plus ``penalty / 2`` times the squared weights of features scaled to unit
deviation, without intercepts: strictly convex, so the optimum is unique and every fit can show how far from
it it stopped (``certificate``, the largest component of the penalised gradient).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyloom.operators.lookup import small
from tallyloom.plans.blocks import Block, packed, pass_over


@dataclass(frozen=True)
class Softmax:
    """Loss of the class probabilities; weights are one row per class, laid end to end."""

    classes: tuple[float, ...]

    def sums(self, block: Block, weights: np.ndarray) -> tuple[float, np.ndarray, int]:
        rows = weights.reshape(len(self.classes), -1)
        margins = np.stack([block.margins(w) for w in rows])
        margins -= margins.max(0)
        log_sum = np.log(np.exp(margins).sum(0))
        truth = np.equal.outer(np.array(self.classes), block.label)
        slope = np.exp(margins - log_sum) - truth
        gradient = np.concatenate([block.spread(s, rows.shape[1]) for s in slope])
        return float((log_sum - (margins * truth).sum(0)).sum()), gradient, len(block.label)


def minimised(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, passes: int = 200,
              tolerance: float = 1e-9, memory: int = 10) -> tuple[np.ndarray, list[float], float]:
    """Point, losses and largest gradient component after quasi-Newton steps with a backtracking line search.

    Every call of ``evaluate`` counts as a pass.  Stops at the tolerance, when passes are used up, or when no step
    lowers the loss any more (rounding).
    """
    point = start
    loss, gradient = evaluate(point)
    losses, used = [loss], 1
    pairs: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=memory)
    while used < passes and np.abs(gradient).max(initial=0.0) > tolerance:
        step = gradient.copy()
        kept = []
        for moved, turned in reversed(pairs):
            share = (moved @ step) / (moved @ turned)
            step -= share * turned
            kept.append(share)
        if pairs:
            moved, turned = pairs[-1]
            step *= (moved @ turned) / (turned @ turned)
        else:
            step /= max(1.0, float(np.linalg.norm(step)))
        for (moved, turned), share in zip(pairs, reversed(kept)):
            step += (share - (turned @ step) / (moved @ turned)) * moved
        slope, length = float(gradient @ step), 1.0
        while used < passes:
            after, turned_to = evaluate(point - length * step)
            used += 1
            if after <= loss - 1e-4 * length * slope + 1e-15 * abs(loss):
                break
            length /= 2
            if length < 1e-10:
                return point, losses, float(np.abs(gradient).max())
        else:
            break
        moved, turned = -length * step, turned_to - gradient
        if moved @ turned > 1e-14 * (turned @ turned):
            pairs.append((moved, turned))
        point, loss, gradient = point + moved, after, turned_to
        losses.append(loss)
    return point, losses, float(np.abs(gradient).max(initial=0.0))


@dataclass
class SoftmaxFit:
    classes: tuple[float, ...]
    weights: np.ndarray  # class x position, for unscaled features
    losses: list[float]
    certificate: float

    def weight_table(self, spark: SparkSession) -> DataFrame:
        count, width = self.weights.shape
        frame = pd.DataFrame({"cls": np.repeat(self.classes, width), "pos": np.tile(np.arange(width, dtype="int32"), count),
                              "w": self.weights.ravel()})
        return spark.createDataFrame(frame, "cls double, pos int, w double")


def fit_softmax(features: DataFrame, width: int, penalty: float = 1.0, passes: int = 200, tolerance: float = 1e-9,
                key: str = "doc_id", label: str = "label") -> SoftmaxFit:
    """Fit over features ``key, label, pos, value``: documents are those with a feature, absent values are 0.

    A feature of one value only carries no weight.  Weights of all classes (classes x width doubles) live on the driver.
    """
    blocks = packed(features, key, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        classes = tuple(sorted(r[0] for r in features.select(F.col(label).cast("double")).distinct().collect()))
        if not classes:
            raise ValueError("no rows to fit")
        side, empty = Softmax(classes), np.zeros(len(classes) * width)
        count = pass_over(blocks, [side], [empty])[0][2]
        moments = features.groupBy("pos").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q")).toPandas()
        spread = np.zeros(width)
        total, square = moments["s"].to_numpy(), moments["q"].to_numpy()
        spread[moments["pos"].to_numpy()] = np.sqrt(np.maximum(0.0, square - total * total / count) / max(1, count - 1))
        scale = np.tile(np.divide(1.0, spread, out=np.zeros(width), where=spread > 1e-12), len(classes))

        def evaluate(v: np.ndarray) -> tuple[float, np.ndarray]:
            loss, gradient, _ = pass_over(blocks, [side], [v * scale])[0]
            return loss / count + penalty / 2 * float(v @ v), gradient * scale / count + penalty * v

        point, losses, certificate = minimised(evaluate, empty, passes, tolerance)
        return SoftmaxFit(classes, (point * scale).reshape(len(classes), width), losses, certificate)
    finally:
        blocks.unpersist()


def predict_softmax(features: DataFrame, fit: SoftmaxFit, keep: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    """``keep`` (the first names the row) and ``pred``, the class of the largest margin (the first of equal ones)."""
    weights = small(fit.weight_table(features.sparkSession), limit=4_000_000)
    margins = features.join(weights, "pos").groupBy(*keep, "cls").agg(F.sum(F.col("value") * F.col("w")).alias("m"))
    first = Window.partitionBy(keep[0]).orderBy(F.desc("m"), "cls")
    return margins.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").select(*keep, F.col("cls").alias("pred"))


def exploded(rows: DataFrame, array: str, keep: Sequence[str]) -> DataFrame:
    """Short dense arrays as features ``keep, pos, value``."""
    return rows.select(*keep, F.posexplode(F.col(array).cast("array<double>")).alias("pos", "value"))
