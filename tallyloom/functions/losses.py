"""Per-row losses and their slopes with respect to the linear margin.

A row's gradient is ``slope * x``, so a model is described by two columns of
(target ``y``, margin).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import numpy as np
from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class RowLoss:
    """``loss(y, margin)`` and ``slope(y, margin)``; ``negative`` is the target of the other class.

    ``arrays`` gives both for arrays of targets and margins.
    """

    loss: Callable[[Column, Column], Column]
    slope: Callable[[Column, Column], Column]
    negative: float
    arrays: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _logistic_arrays(y: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    near = np.exp(-np.abs(m))
    return -y * m + np.maximum(m, 0.0) + np.log1p(near), np.where(m >= 0, 1.0, near) / (1.0 + near) - y


def logistic() -> RowLoss:
    """``-y m + ln(1 + e^m)`` for y in 0/1, in the form that does not overflow."""
    return RowLoss(
        loss=lambda y, m: -y * m + F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m))),
        slope=lambda y, m: 1.0 / (1.0 + F.exp(-m)) - y,
        negative=0.0,
        arrays=_logistic_arrays,
    )


def hinge() -> RowLoss:
    """``max(0, 1 - y m)`` for y in -1/+1; the slope is 0 only beyond the margin."""
    return RowLoss(
        loss=lambda y, m: F.greatest(F.lit(0.0), 1.0 - y * m),
        slope=lambda y, m: F.when(y * m > 1.0, F.lit(0.0)).otherwise(-y),
        negative=-1.0,
        arrays=lambda y, m: (np.maximum(0.0, 1.0 - y * m), np.where(y * m > 1.0, 0.0, -y)),
    )


def weighted_hinge(positive_share: float) -> RowLoss:
    """Hinge where positives weigh the negative share and negatives the positive share."""
    pr, nr = float(positive_share), 1.0 - float(positive_share)

    def weight(y: Column) -> Column:
        return F.when(y > 0, F.lit(nr)).otherwise(F.lit(pr))

    def arrays(y: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.where(y > 0, nr, pr)
        return np.maximum(0.0, w * (1.0 - y * m)), np.where(y * m > 1.0, 0.0, -y * w)

    return RowLoss(
        loss=lambda y, m: F.greatest(F.lit(0.0), weight(y) * (1.0 - y * m)),
        slope=lambda y, m: F.when(y * m > 1.0, F.lit(0.0)).otherwise(-y * weight(y)),
        negative=-1.0,
        arrays=arrays,
    )
