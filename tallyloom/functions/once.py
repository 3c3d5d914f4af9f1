"""Compute an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(expression: Column) -> Column:
    """The expression behind a one-element ``explode``.

    Filters and projections on a plain column are rewritten in terms of the
    expression that made it, so ten filters on ten fields of a split line would
    split the line ten times.  They stop at ``explode``.
    """
    return F.explode(F.array(expression))


def each(df: DataFrame, array: str, out: str, *keep: str) -> DataFrame:
    """One row per element.

    A plain ``explode`` of a computed column makes the optimizer add filters on
    its size and its presence, which compute the array again; the outer form does
    not, and the row it adds for an empty array is dropped afterwards.
    """
    return df.select(*keep, F.explode_outer(array).alias(out)).where(F.col(out).isNotNull())
