"""Projections, recodes, null policy and simple filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def null_sentinels(df: DataFrame, sentinels: Sequence[str] = ("-999", "NA")) -> DataFrame:
    """Turn sentinel text into null in every string column."""
    marks = [str(s) for s in sentinels]
    fixed = {
        f.name: F.when(~F.trim(F.col(f"`{f.name}`")).isin(marks), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(fixed) if fixed else df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; a name the table lacks is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumnsRenamed(dict(names))


def pick_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Keep and order columns by 1-based position; negative positions are dropped from the kept ones."""
    dropped = {-p for p in positions if p < 0}
    kept = [p for p in positions if p > 0] or list(range(1, len(df.columns) + 1))
    order = list(dict.fromkeys(p for p in kept if p not in dropped))
    return df.select([F.col(f"`{df.columns[p - 1]}`") for p in order])


def recode_value(column: Column | str, old, new) -> Column:
    """Replace one value; null stays null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c == old, F.lit(new)).otherwise(c)


def fill_null(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def before(df: DataFrame, column: str, cutoff) -> DataFrame:
    """Rows strictly before the cutoff; null dates drop out."""
    return df.where(F.col(column) < F.lit(cutoff))


def drop_maximum(df: DataFrame, column: str, na: str = "skip") -> DataFrame:
    """Drop every row equal to the column maximum.

    The maximum is a scalar subquery, so the comparison is pushed to the scan.
    ``na='propagate'``: one null anywhere leaves no comparable maximum, so no row is kept.
    """
    top = F.max(column)
    if na == "propagate":
        top = F.when(F.count_if(F.col(column).isNull()) == 0, top)
    return df.where(F.col(column) < df.agg(top.alias("top")).scalar())


def class_from_prefix(doc_id: Column | str) -> Column:
    """Class of a document id: ``AD`` 1, ``AU`` 2, anything else 0."""
    head = F.substring(F.col(doc_id) if isinstance(doc_id, str) else doc_id, 1, 2)
    return F.when(head == "AD", 1).when(head == "AU", 2).otherwise(0)


def sign_from_prefix(doc_id: Column | str, prefix: str = "AU", negative: float = -1.0) -> Column:
    """One class against the rest: 1.0 for the prefix, else ``negative`` (-1 or 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.when(F.substring(c, 1, 2) == prefix, F.lit(1.0)).otherwise(F.lit(float(negative)))


def decide(score: Column | str, threshold: float = 0.0, symbol=1, other=0, inclusive: bool = False) -> Column:
    """``symbol`` when the score passes the threshold (strictly, or also at it), else ``other``."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= threshold if inclusive else s > threshold, F.lit(symbol)).otherwise(F.lit(other))


def parse_tagged_line(df: DataFrame, line: str = "value") -> DataFrame:
    """``<doc id="X" url="..." ...>body</doc>`` to ``doc_id`` and ``body``.

    The body starts after the first ``">`` and loses its last six characters.
    A line without the marks gets null ``doc_id`` or ``body`` instead of failing.
    """
    v = F.col(line)
    id_at, id_end, body_at = F.instr(v, 'id="'), F.instr(v, '" url='), F.instr(v, '">')
    doc_id = F.when((id_at > 0) & (id_end > 0), F.substring(v, id_at + 4, F.greatest(id_end - id_at - 4, F.lit(0))))
    body = F.when(body_at > 0, F.substring(v, body_at + 2, F.greatest(F.length(v) - body_at - 7, F.lit(0))))
    return df.withColumns({"doc_id": doc_id, "body": body})


def synthetic_ids(df: DataFrame, out: str = "doc_id", prefix: str = "AD", key: Column | str | None = None) -> DataFrame:
    """Prefix + unique id.  Pass a ``key`` for ids that are the same on every run."""
    if key is None:
        number = F.monotonically_increasing_id()
    else:
        number = F.col(key) if isinstance(key, str) else key
    return df.withColumn(out, F.concat(F.lit(prefix), number.cast("string")))


def numbered_copies(df: DataFrame, out: str = "key") -> DataFrame:
    """A key per row that is the same on any layout: hash of the row and its number among equal rows.

    Equal rows are counted map-side and repeated after the shuffle, so a row that
    makes up much of the data is no hot group.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    each = counted.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_i"))
    return each.withColumn(out, F.concat_ws("-", F.lower(F.hex(F.xxhash64(*df.columns))), F.col("_i").cast("string"))).drop("_i")


def bag_union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union that keeps copies and matches columns by name."""
    for other in others:
        first = first.unionByName(other)
    return first
