"""Trip regression from lines to mean squared error."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.operators.measures import mean_squared_error, score_columns
from tallyloom.operators.recode import numbered_copies
from tallyloom.operators.sampling import weighted_split
from tallyloom.operators.validity import split_fields, trip_features, valid_trips
from tallyloom.plans.descent import Fit, fit_linear, fit_linear_batches
from tallyloom.sources.sinks import reused

INPUTS = ["x0", "x1", "x2", "x3", "x4"]


def trip_table(lines: DataFrame) -> DataFrame:
    """Valid trips of comma-separated lines as features.

    Rows are keyed by a column ``key`` or, without one, by the line and its number among equal lines.
    """
    keyed = lines if "key" in lines.columns else numbered_copies(lines.select("value"))
    fields = split_fields(keyed, carry=["key"])
    return trip_features(valid_trips(fields), carry=["key"])


def run_trips(lines: DataFrame, batch: int | None = None, passes: int = 300, seed: int = 13,
              fast: bool = True) -> tuple[Fit, DataFrame]:
    """Fit on nine tenths and measure on the rest; ``batch`` switches to mini-batches."""
    trips = trip_table(lines)
    training, testing = weighted_split(trips, "key", [0.9, 0.1], seed)
    if batch is None:
        fit = fit_linear(training, INPUTS, "y", passes=passes)
    else:
        with reused(training) as (kept,):
            fit = fit_linear_batches(kept, INPUTS, "y", "key", batch, passes=passes, seed=seed, fast=fast)
    scored = score_columns(testing, list(fit.weights), INPUTS)
    return fit, mean_squared_error(scored)

