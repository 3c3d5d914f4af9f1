"""Query that mixes documents to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import mixture
from tallyloom.llm.registry import query, table

#: Wanted share of tokens by domain.
WEIGHTS = {"high": 0.8, "low": 0.15, "toxic": 0.05}


@query()
def op7_mixing_rates(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mixed(table(spark, folder, "documents"), table(spark, folder, "labels"), WEIGHTS)
