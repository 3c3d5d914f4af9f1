"""Small collections in, files out, reuse, previews."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F


def from_values(spark: SparkSession, values: Iterable, schema: str) -> DataFrame:
    """A driver-side list as a DataFrame."""
    return spark.createDataFrame([v if isinstance(v, (tuple, list, Row)) else (v,) for v in values], schema)


def numbers(spark: SparkSession, n: int, name: str = "pos") -> DataFrame:
    """0 .. n-1, generated by the executors."""
    return spark.range(n).select(F.col("id").alias(name))


def write_single_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text file.  For short results such as a loss history: the rows pass through one task."""
    df.select(F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in df.columns]).alias("value")) \
        .coalesce(1).write.mode(mode).text(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


@contextmanager
def reused(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames in memory (spilling to disk) while a block reads them repeatedly."""
    kept = tuple(f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames)
    try:
        yield kept
    finally:
        for f in kept:
            f.unpersist()


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def collect_small(df: DataFrame, at_most: int = 100_000) -> list[Row]:
    """Rows on the driver, refused when there are more than ``at_most`` (never cut short)."""
    rows = df.limit(at_most + 1).collect()
    if len(rows) > at_most:
        raise ValueError(f"more than {at_most} rows: aggregate or limit first")
    return rows
