"""Text lines and CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tallyloom.operators.recode import null_sentinels
from tallyloom.operators.validity import FIELDS


def spread(df: DataFrame) -> DataFrame:
    """Move the rows of an input with fewer splits than cores (one gzip file, one row group) over all cores.

    Input with enough splits, the normal case for large data, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (``value``); compressed files are decoded by the reader."""
    return spread(spark.read.text(path))


def trip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 17-column CSV, every column as text; validity rules cast later.

    Quoting is off, as in a plain split.  The reader pads or cuts lines of another
    width, so where the width matters use ``text_lines`` with ``split_fields``.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])
    return spark.read.schema(schema).csv(path, header=False, mode="PERMISSIVE", quote="")


def headed_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               encoding: str = "UTF-8", sentinels: tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header.  Without a schema all columns are text; ``sentinels`` become null."""
    reader = spark.read.option("header", True).option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return null_sentinels(df, sentinels) if sentinels else df


def latin1_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header in a single-byte encoding."""
    return headed_csv(spark, path, schema, encoding="ISO-8859-1")
