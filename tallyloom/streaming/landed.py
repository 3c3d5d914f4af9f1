"""The paging loop as a stream: page files are read as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.sources.pages import PAGE_SCHEMA


def landing_records(spark: SparkSession, path: str, pages_per_trigger: int = 100) -> DataFrame:
    """Records of page files in landing order, a bounded number of files per trigger."""
    pages = (
        spark.readStream.schema(PAGE_SCHEMA).option("multiLine", True)
        .option("maxFilesPerTrigger", pages_per_trigger).json(path)
    )
    return pages.select(F.inline("data")).withColumn("created_at", F.to_timestamp("created_at"))


def landing_daily_counts(records: DataFrame, late: str = "1 day") -> DataFrame:
    """Counts of whole days; a day is emitted once no record of it can still arrive."""
    return (
        records.withWatermark("created_at", late)
        .groupBy(F.window("created_at", "1 day"))
        .agg(F.count("*").alias("n"))
        .select(F.to_date("window.start").alias("day"), "n")
    )
