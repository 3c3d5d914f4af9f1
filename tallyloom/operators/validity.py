"""Validity rules and features of the 17-field trip records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.once import once

FIELDS = [f"_c{i}" for i in range(17)]


def number(text: Column | str) -> Column:
    """Text as a double, null when it is no number.

    ``nan`` and ``inf`` are numbers here.  The cast would also take a Java type
    suffix (``1d``) and hexadecimal floats, which are no plain numbers.
    """
    c = F.lower(F.trim(F.col(text) if isinstance(text, str) else text))
    suffixed = F.right(c, F.lit(1)).isin("d", "f") & ~c.isin("inf", "+inf", "-inf")
    return F.when(~suffixed & ~F.contains(c, F.lit("x")), c.try_cast("double"))


def is_number(text: Column | str) -> Column:
    return number(text).isNotNull()


def split_fields(df: DataFrame, line: str = "value", width: int = 17, carry: Sequence[str] = ()) -> DataFrame:
    """Plain comma split without quoting; lines of another width drop out."""
    return (
        df.select(*carry, once(F.split(F.col(line), ",")).alias("_parts"))
        .where(F.size("_parts") == width)
        .select(*carry, *[F.col("_parts")[i].alias(f"_c{i}") for i in range(width)])
    )


def valid_trips(df: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Keep trips of 2-60 minutes, 1-50 miles, fare 3-200 and field 15 of at least 3 (bounds included).

    NaN fails every bound: Spark orders it above all numbers, so the open bound
    tests for it.  Rows whose target (field 16) is no number drop out too.
    """
    used = {"seconds": 4, "miles": 5, "fare": 11, "extra": 12, "paid": 15, "target": 16}
    numbers = F.struct(*[number(fields[i]).alias(name) for name, i in used.items()])
    parsed = df.select("*", once(numbers).alias("_n"))
    n = {name: F.col(f"_n.{name}") for name in used}
    return parsed.where(
        n["seconds"].between(120, 3600)
        & n["miles"].between(1, 50)
        & n["fare"].between(3, 200)
        & n["extra"].isNotNull()
        & (n["paid"] >= 3)
        & ~F.isnan(n["paid"])
        & n["target"].isNotNull()
    ).drop("_n")


def minutes(seconds: Column | str) -> Column:
    return number(seconds) / 60.0


def trip_features(df: DataFrame, fields: Sequence[str] = FIELDS, carry: Sequence[str] = ()) -> DataFrame:
    """Intercept, minutes, miles, fare, extra and the target of valid trips."""
    return df.select(
        *carry,
        F.lit(1.0).alias("x0"),
        minutes(fields[4]).alias("x1"),
        number(fields[5]).alias("x2"),
        number(fields[11]).alias("x3"),
        number(fields[12]).alias("x4"),
        number(fields[16]).alias("y"),
    )
