"""Row numbers, running totals and forward fill over one global order.

A window without a partition key would move every row to one task.  Instead the
rows are range-partitioned by the order columns (the whole order tuple, so
equal leading values are split too), sorted, and checkpointed once; after that
each partition needs a single number from the partitions before it.  The
checkpoint fixes which row is in which partition: the totals per partition and
the rows are read by different jobs and must agree, also when an executor is
lost in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.session import settled

PART, POS = "_part", "_pos"
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def _sort_key(order: str | Column) -> Column:
    return F.col(order) if isinstance(order, str) else order


def lay_out(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in global order with their partition number and place in it (both from 0).

    ``order`` must be a total order.  Select the columns you need first: they
    are written once.
    """
    keys = [_sort_key(o) for o in order]
    laid = settled(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return (
        laid.withColumn(PART, F.shiftright("_mid", 33))
        .withColumn(POS, F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_mid")
    )


def row_index(df: DataFrame, order: Sequence[str | Column], out: str = "row_index") -> DataFrame:
    """Exact row numbers 1..N in the given order."""
    laid = lay_out(df, order)
    starts = (
        laid.groupBy(PART).agg(F.count("*").alias("_n"))
        .select(PART, F.coalesce(F.sum("_n").over(Window.orderBy(PART).rowsBetween(*_BEFORE)), F.lit(0)).alias("_start"))
    )
    # one row per partition: bounded by the number of tasks, not by the data
    return (
        laid.join(F.broadcast(starts), PART)
        .withColumn(out, F.col("_start") + F.col(POS) + 1)
        .drop(PART, POS, "_start")
    )


def running_total(df: DataFrame, order: Sequence[str], values: str | Sequence[str], outs: str | Sequence[str],
                  group: Sequence[str] = ()) -> DataFrame:
    """Running sums including the current row, over all rows or within ``group``.

    A group that spans many partitions is summed in all of them in parallel:
    only the sums per partition are put in order.
    """
    group = list(group)
    values = [values] if isinstance(values, str) else list(values)
    outs = [outs] if isinstance(outs, str) else list(outs)
    laid = lay_out(df, [*group, *order])
    sums = laid.groupBy(PART, *group).agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    before = Window.partitionBy(*group).orderBy(PART).rowsBetween(*_BEFORE)
    carry = sums.select(
        F.col(PART).alias("_cp"), *[F.col(g).alias(f"_g_{g}") for g in group],
        *[F.sum(f"_s_{v}").over(before).alias(f"_c_{v}") for v in values],
    )
    inner = Window.partitionBy(PART, *group).orderBy(POS).rowsBetween(*_UP_TO)
    match = F.col(PART) == F.col("_cp")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    local = laid.withColumns({f"_l_{v}": F.sum(v).over(inner) for v in values})
    # without groups carry holds one row per partition
    joined = local.join(carry if group else F.broadcast(carry), match)
    totals = {o: F.col(f"_l_{v}") + F.coalesce(F.col(f"_c_{v}"), F.lit(0)) for v, o in zip(values, outs)}
    return joined.withColumns(totals).select(*df.columns, *outs)


def forward_fill(df: DataFrame, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the last value before them in the order; leading nulls stay."""
    laid = lay_out(df, order)
    last_here = laid.groupBy(PART).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_t_{c}") for c in columns]
    )
    before = Window.orderBy(PART).rowsBetween(*_BEFORE)
    carry = last_here.select(
        PART, *[F.last(f"_t_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in columns]
    )
    inner = Window.partitionBy(PART).orderBy(POS).rowsBetween(*_UP_TO)
    filled = laid.withColumns({f"_f_{c}": F.last(c, ignorenulls=True).over(inner) for c in columns})
    # carry holds one row per partition
    return (
        filled.join(F.broadcast(carry), PART)
        .withColumns({c: F.coalesce(f"_f_{c}", f"_c_{c}") for c in columns})
        .select(*df.columns)
    )


def zip_rows(left: DataFrame, right: DataFrame, left_order: Sequence[str | Column], right_order: Sequence[str | Column],
             pad: bool = False) -> DataFrame:
    """The n-th row of one table beside the n-th row of the other, each in its own total order.

    Tables of different length are cut at the shorter one's end; ``pad`` keeps the longer one's rows, with
    nulls beside them.  Column names must differ.
    """
    clash = sorted({c.lower() for c in left.columns} & {c.lower() for c in right.columns})
    if clash:
        raise ValueError(f"columns of both tables: {', '.join(clash)}")
    one, two = row_index(left, left_order, "_place"), row_index(right, right_order, "_place")
    return one.join(two, "_place", "full" if pad else "inner").select(*left.columns, *right.columns)


def batches(df: DataFrame, order: Sequence[str], size: int, out: str = "batch_id") -> DataFrame:
    """Consecutive batches of ``size`` rows, numbered from 0."""
    return row_index(df, order, "_i").withColumn(out, F.floor((F.col("_i") - 1) / size).cast("long")).drop("_i")


def batch_count(df: DataFrame, size: int) -> DataFrame:
    return df.agg(F.ceil(F.count("*") / size).cast("long").alias("batches"))


def take_batches(df: DataFrame, count: int, batch: str = "batch_id") -> DataFrame:
    return df.where(F.col(batch) < count)


def skip_batches(df: DataFrame, count: int, batch: str = "batch_id") -> DataFrame:
    return df.where(F.col(batch) >= count)


def top_rows(df: DataFrame, order: Sequence[Column | str], count: int) -> DataFrame:
    """First rows of an order (top-k per task, then of the tasks)."""
    return df.orderBy(*order).limit(count)
