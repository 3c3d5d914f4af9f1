"""Places of rows within groups, also where one group holds most rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.operators.lookup import small
from tallyloom.session import settled, use_checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a compressed table in the shared folder, for texts and for columns that are read apart."""
    spark = df.sparkSession
    path = f"{use_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def met(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns, null equal to null; the columns are kept once."""
    other = right.withColumnsRenamed({name: f"_r_{name}" for name in names})
    match = F.lit(True)
    for name in names:
        match = match & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return left.join(other, match, how).drop(*[f"_r_{name}" for name in names])


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (place in its group from 0) and ``n`` (rows of the group).

    Rows are range-partitioned by group and order, so that a large group spans many
    tasks, sorted and written once; a row's place is its number in its partition less
    that of the group's first row there, plus the group's rows in partitions before.
    That needs one line per group and partition it occurs in.  Nulls come first; equal
    rows get places in any order.  ``rows`` should be ``settled`` (they are sampled first).
    """
    keys = [*group, *order]
    laid = settled(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id()))
    laid = laid.withColumn("_part", F.shiftright("_mid", 33))
    parts = laid.groupBy("_part", *group).agg(F.min("_mid").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    starts = small(settled(parts.select(
        "_part", *group, "_first", F.sum("_rows").over(whole).alias("n"),
        F.coalesce(F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))))
    return met(laid, starts, ["_part", *group]).select(
        *rows.columns, (F.col("_mid") - F.col("_first") + F.col("_before")).alias("pos"), "n")
