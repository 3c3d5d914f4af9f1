"""Keyed random numbers.  The same key and seed give the same draw on any layout."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

SPAN = 2**52  # a draw is the first 13 hex digits of an md5
BUCKETS = 2**16  # leading-bit buckets of a draw


def bucket_of(drawn: Column) -> Column:
    """The leading 16 bits of a draw: equal-sized buckets whatever the keys look like."""
    return F.shiftright(drawn, 36)


def _digits(key: tuple[Column | str, ...], seed: int | str) -> Column:
    parts = [F.col(k) if isinstance(k, str) else k for k in key]
    text = F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(str(seed)))
    return F.substring(F.md5(text), 1, 13)


def draw(*key: Column | str, seed: int | str = 13) -> Column:
    """Integer in [0, 2**52) from the md5 of ``key:seed``; any SQL engine with md5 can repeat it."""
    return F.conv(_digits(key, seed), 16, 10).cast("bigint")


def drawn_below(bound: int, *key: Column | str, seed: int | str = 13) -> Column:
    """Whether the draw is below ``bound``: hex digits of one length compare as their numbers do, without making numbers."""
    return F.lit(True) if bound >= SPAN else _digits(key, seed) < F.lit(f"{max(0, bound):013x}")


def uniform(*key: Column | str, seed: int | str = 13) -> Column:
    """Keyed uniform in [0, 1)."""
    return draw(*key, seed=seed) / F.lit(SPAN)


def fast_uniform(*key: Column | str, seed: int | str = 13) -> Column:
    """Keyed uniform in [0, 1) from xxhash64: several times cheaper than md5, Spark only."""
    parts = [F.col(k) if isinstance(k, str) else k for k in key]
    mixed = F.xxhash64(*parts, F.lit(str(seed)))
    return F.shiftrightunsigned(mixed, 11) / F.lit(float(2**53))


def normal(*key: Column | str, seed: int | str = 13) -> Column:
    """Keyed standard normal (Box-Muller on two keyed uniforms)."""
    first = (draw(*key, seed=f"{seed}a") + 1) / F.lit(SPAN)
    second = uniform(*key, seed=f"{seed}b")
    return F.sqrt(-2.0 * F.log(first)) * F.cos(2.0 * math.pi * second)
