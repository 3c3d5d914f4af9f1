"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    def register(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


# SQL pieces shared by several texts.

def sql_draw(key: str, seed: int | str = 13) -> str:
    return f"('0x' || substr(md5(({key}) || ':{seed}'), 1, 13))::BIGINT"


def sql_uniform(key: str, seed: int | str = 13) -> str:
    return f"({sql_draw(key, seed)} / 4503599627370496::DOUBLE)"


def sql_words(text: str = "text") -> str:
    return (
        f"list_filter(string_split(lower(regexp_replace({text}, '[^a-zA-Z]+', ' ', 'g')), ' '), lambda w: w <> '')"
    )
