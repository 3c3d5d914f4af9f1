"""Tokens to sentences and integer sequences, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _each(records: Column | str, name: str) -> Column:
    return F.transform(records, lambda r: r[name])


def sentences(tokens: DataFrame, sid: str, order: str, word: str, lists: Sequence[str] = (),
              text: str = "sentence", chunk: int = 1024) -> DataFrame:
    """One row per sentence: words joined with a blank and each of ``lists`` as an ordered array.

    ``order`` is a number.  Tokens are first gathered and sorted in chunks of an
    order range, so a sentence that holds much of the data is sorted by many
    tasks and its final row only strings finished chunks together.
    """
    record = F.struct(F.col(order).alias("_o"), F.col(word).alias("_w"), *lists)
    parts = tokens.groupBy(sid, F.floor(F.col(order) / chunk).alias("_chunk")).agg(
        F.array_sort(F.collect_list(record)).alias("_part")
    )
    pieces = parts.select(
        sid,
        F.struct(
            "_chunk",
            F.array_join(_each("_part", "_w"), " ").alias("_text"),
            *[_each("_part", c).alias(c) for c in lists],
        ).alias("_piece"),
    )
    joined = pieces.groupBy(sid).agg(F.array_sort(F.collect_list("_piece")).alias("_p"))
    return joined.select(
        sid,
        F.array_join(_each("_p", "_text"), " ").alias(text),
        *[F.flatten(_each("_p", c)).alias(c) for c in lists],
    )


def encode(df: DataFrame, key: Sequence[str], items: str, table: DataFrame, out: str = "ids",
           unknown: int | None = None, term: str = "term", ident: str = "id") -> DataFrame:
    """Array of terms to an array of ids, in order.

    A term the table lacks becomes ``unknown`` or, when that is None, is dropped.
    Rows without any known term keep an empty array.  ``key`` identifies a row;
    its tokens come from that row alone, so they are gathered before the shuffle.
    """
    long = df.select(*key, F.posexplode_outer(items).alias("_place", term))
    found = F.col(ident) if unknown is None else F.coalesce(F.col(ident), F.lit(unknown))
    pair = F.when(F.col(term).isNotNull() & found.isNotNull(), F.struct(F.col("_place"), found.alias("_id")))
    gathered = (
        long.join(table.select(term, ident), term, "left")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(pair)).alias("_pairs"))
    )
    return gathered.select(*key, _each("_pairs", "_id").alias(out))


def decode(df: DataFrame, key: Sequence[str], ids: str, table: DataFrame, out: str = "words",
           term: str = "term", ident: str = "id", skip_zero: bool = True) -> DataFrame:
    """Array of ids to the array of their terms, padding zeros left out."""
    kept = F.filter(ids, lambda x: x > 0) if skip_zero else F.col(ids)
    long = df.select(*key, F.posexplode_outer(kept).alias("_place", ident))
    pair = F.when(F.col(term).isNotNull(), F.struct("_place", term))
    gathered = (
        long.join(table.select(term, ident), ident, "left")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(pair)).alias("_pairs"))
    )
    return gathered.select(*key, _each("_pairs", term).alias(out))


def pad(ids: Column | str, length: int, fill: int | Column = 0, padding: str = "post",
        truncate: str | None = "pre") -> Column:
    """Fixed-length sequence.  ``truncate='pre'`` cuts from the front, ``'post'`` from the end, None never cuts."""
    c = F.col(ids) if isinstance(ids, str) else ids
    if truncate == "pre":
        c = F.when(F.size(c) > length, F.slice(c, -length, length)).otherwise(c)
    elif truncate == "post":
        c = F.slice(c, 1, length)
    elif truncate is not None:
        raise ValueError("truncate must be 'pre', 'post' or None")
    value = fill if isinstance(fill, Column) else F.lit(fill)
    rest = F.array_repeat(value, F.greatest(F.lit(length) - F.size(c), F.lit(0)))
    return F.concat(c, rest) if padding == "post" else F.concat(rest, c)


def trim_prediction(predicted: Column | str, sentence: Column | str) -> Column:
    """Cut a padded prediction to the number of non-zero ids of its sentence."""
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    s = F.col(sentence) if isinstance(sentence, str) else sentence
    return F.slice(p, F.lit(1), F.size(F.filter(s, lambda x: x > 0)))


def map_label(label: Column | str, names: dict) -> Column:
    """Name of a label from a small fixed map (null if the map lacks it)."""
    c = F.col(label) if isinstance(label, str) else label
    pairs = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.element_at(pairs, c)
