"""Dates and times as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def short_date(text: Column | str) -> Column:
    """``m/d/yy`` to a date; 00-68 mean 20xx, 69-99 mean 19xx; text that is no date gives null."""
    parsed = F.to_date(F.try_to_timestamp(_col(text), F.lit("M/d/yy")))
    return F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)


def day_bounds(as_of: Column) -> tuple[Column, Column]:
    """First and last second of the day before ``as_of`` as ISO text."""
    day = F.date_sub(as_of, 1)
    return (
        F.date_format(day, "yyyy-MM-dd'T00:00:00Z'"),
        F.date_format(day, "yyyy-MM-dd'T23:59:59Z'"),
    )


def in_previous_day(ts: Column | str, as_of: Column) -> Column:
    """True for times of the UTC day before ``as_of``; a bare range so it reaches the scan."""
    ts = _col(ts)
    return (ts >= F.date_sub(as_of, 1)) & (ts < as_of)


def iso_time(year, month, day, hour=0, minute=0, second=0) -> Column:
    """ISO text from parts; an impossible date or time gives null."""
    parts = [p if isinstance(p, Column) else F.lit(p) for p in (year, month, day, hour, minute, second)]
    made = F.try_make_timestamp_ntz(*parts)
    return F.date_format(made, "yyyy-MM-dd'T'HH:mm:ss'Z'")
