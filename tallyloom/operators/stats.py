"""Group statistics, frequency tables and histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _average(column: str, na: str) -> Column:
    if na == "skip":
        return F.avg(column)
    if na == "propagate":
        return F.when(F.count_if(F.col(column).isNull()) == 0, F.avg(column))
    raise ValueError("na must be 'skip' or 'propagate'")


def group_means(df: DataFrame, by: str, measures: dict[str, str], na: str = "propagate") -> DataFrame:
    """Mean of measures per category, largest first in the order the measures are given.

    ``measures`` maps output name to column.  ``na='propagate'``: a null in a
    group makes its mean null; ``'skip'`` ignores nulls.
    """
    out = df.groupBy(by).agg(*[_average(c, na).alias(name) for name, c in measures.items()])
    return out.orderBy(*[F.desc_nulls_last(name) for name in measures], by)


def mean_of(df: DataFrame, column: str, na: str = "propagate", out: str = "mean") -> DataFrame:
    return df.agg(_average(column, na).alias(out))


def correlation(df: DataFrame, x: str, y: str, na: str = "propagate", out: str = "r") -> DataFrame:
    """Pearson correlation; Spark skips pairs with a null, ``propagate`` gives null if there is one."""
    r = F.corr(x, y)
    if na == "propagate":
        r = F.when(F.count_if(F.col(x).isNull() | F.col(y).isNull()) == 0, r)
    return df.agg(r.alias(out))


def frequencies(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Counts of the values without nulls."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(out))


def shares(df: DataFrame, column: str, out: str = "share", weight: str | None = None) -> DataFrame:
    """Counts over their total.  The total is a scalar subquery, not a window over all groups."""
    known = df.where(F.col(column).isNotNull())
    amount = F.sum(weight) if weight else F.count("*")
    total = known.agg(amount.cast("double").alias("n")).scalar()
    return known.groupBy(column).agg(amount.alias("n")).withColumn(out, F.col("n") / total)


def distinct_values(df: DataFrame, column: str, order: str | None = None) -> DataFrame:
    """Distinct values, null included; with ``order`` also where each appears first."""
    if order is None:
        return df.select(column).distinct()
    return df.groupBy(column).agg(F.min(order).alias("first_seen"))


def class_counts(df: DataFrame, label: str = "label", out: str = "n") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias(out))


def class_ratio(df: DataFrame, label: str, top, bottom, out: str = "ratio") -> DataFrame:
    """Rows of one class over rows of another."""
    return df.agg(F.try_divide(F.count_if(F.col(label) == top), F.count_if(F.col(label) == bottom)).alias(out))


def density(df: DataFrame, column: str, bins: int = 30, by: str | None = None, align: str = "centred") -> DataFrame:
    """Equal-width density histogram: ``bin, left, right, n, density``; empty bins have no row.

    ``align='centred'``: the first bin is centred on the minimum and the last on
    the maximum (width = range / (bins - 1)).  ``'edges'``: bins cover exactly
    minimum to maximum.  Bins are closed on the right.  With ``by`` the edges are
    shared and the density is that within each category.  Minimum, maximum and
    count are read first.
    """
    known = df.where(F.col(column).isNotNull())
    x = F.col(column).cast("double")
    lo, hi, rows = known.agg(F.min(x), F.max(x), F.count("*")).first()
    lo, hi = lo or 0.0, hi or 0.0
    centred = align == "centred" and bins > 1
    width = (hi - lo) / (bins - 1 if centred else bins) or 0.1
    origin = lo - width / 2 if centred else lo
    place = F.ceil((x - F.lit(origin)) / F.lit(width)) - 1
    place = F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    keys = [by] if by else []
    binned = known.select(*keys, place.alias("bin")).groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    # the groups hold at most ``bins`` rows each
    total = F.sum("n").over(Window.partitionBy(by)) if by else F.lit(rows)
    left = F.lit(origin) + F.col("bin") * F.lit(width)
    return binned.select(
        *keys, "bin", left.alias("left"), (left + F.lit(width)).alias("right"), "n",
        (F.col("n") / (total * F.lit(width))).alias("density"),
    )


def round_histogram(df: DataFrame, column: str) -> DataFrame:
    """Counts over round-numbered bins, about log2(N) + 1 of them, closed on the right.

    The step is 1, 2, 5 or 10 times a power of ten, whichever suits
    range / bin count best (biased to larger steps as base statistics packages do).
    """
    known = df.where(F.col(column).isNotNull())
    x = F.col(column).cast("double")
    lo, hi, rows = known.agg(F.min(x), F.max(x), F.count("*")).first()
    if not rows:
        return known.select(x.alias("left"), x.alias("right"), F.lit(0).cast("bigint").alias("n"))
    step = _round_step((hi - lo) / math.ceil(math.log2(rows) + 1) or 1.0)
    first = math.floor(lo / step + 1e-7)
    place = F.greatest(F.ceil(x / F.lit(step) - 1e-7) - 1, F.lit(first)).cast("bigint")
    return (
        known.select(place.alias("_bin")).groupBy("_bin").agg(F.count("*").alias("n"))
        .select((F.col("_bin") * F.lit(step)).alias("left"), ((F.col("_bin") + 1) * F.lit(step)).alias("right"), "n")
    )


def _round_step(cell: float) -> float:
    """1, 2, 5 or 10 times a power of ten: a larger one when it is near enough to the wanted cell."""
    step = base = 10.0 ** math.floor(math.log10(cell))
    for factor, bias in ((2, 1.5), (5, 2.75), (10, 1.5)):
        if factor * base - cell < bias * (cell - step):
            step = factor * base
    return step


def daily_counts(df: DataFrame, ts: str, out: str = "n") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias(out))


def last_complete_day(counts: DataFrame, day: str = "day") -> DataFrame:
    """The second-latest day: the latest one is still filling up."""
    return counts.orderBy(F.desc(day)).limit(2).orderBy(day).limit(1).where(
        F.col(day) < counts.agg(F.max(day).alias("d")).scalar()
    )


def sample_means(samples: DataFrame, column: str, sample_id: str = "sample_id") -> DataFrame:
    return samples.groupBy(sample_id).agg(F.avg(column).alias("mean"))


def column_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.max(c).alias(c) for c in columns])
