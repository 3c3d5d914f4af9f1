"""Search predicates and lookups by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def _bytes(df: DataFrame) -> Column:
    """Size of a row: 16 bytes and 8 per column, and the length of what varies."""
    varying = [F.octet_length(F.col(f.name).cast("string")) for f in df.schema.fields
               if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    return sum((F.coalesce(v, F.lit(0)) for v in varying), F.lit(16 + 8 * len(df.columns))).cast("bigint")


def small(df: DataFrame, limit: int = BROADCAST_ROWS, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a join side for broadcast only after counting its rows and summing their bytes.

    At most ``limit + 1`` rows are looked at.  A larger side is returned unmarked,
    and Spark picks a shuffle join (with AQE skew handling) for it.
    """
    rows, size = df.limit(limit + 1).agg(F.count("*"), F.coalesce(F.sum(_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= limit and size <= limit_bytes else df


def search(text: Column | str, any_of: Sequence[str], is_copy: Column | None = None,
           lang: Column | str | None = None, want_lang: str | None = None) -> Column:
    """Any of the tags as whole words (any case), not a re-post, in one language."""
    c = F.col(text) if isinstance(text, str) else text
    alternatives = "|".join(f"\\Q{tag}\\E" for tag in any_of)
    found = c.rlike(f"(?i)(^|[^\\w])({alternatives})([^\\w]|$)")
    if is_copy is not None:
        found = found & ~is_copy
    if want_lang is not None:
        found = found & ((F.col(lang) if isinstance(lang, str) else lang) == want_lang)
    return found


def by_ids(df: DataFrame, ids: DataFrame | Sequence, key: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key is in the id list (a table of ids or a short literal list), with optional fields."""
    if isinstance(ids, DataFrame):
        found = df.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")
    else:
        found = df.where(F.col(key).isin(list(ids)))
    return found.select(*fields) if fields else found


def field_of(records: Column | str, name: str) -> Column:
    """One field of each record in an array of structs."""
    c = F.col(records) if isinstance(records, str) else records
    return F.transform(c, lambda r: r[name])
