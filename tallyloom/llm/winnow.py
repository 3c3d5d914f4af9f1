"""Winnowed document fingerprints in DataFrame functions only.

A text is cut into units: words in pieces of at most four characters, and single
characters in scripts that are written without spaces.  Each unit is hashed
once and makes a gram with the ``k - 1`` units before it (fewer at the start of
the text).  Of every ``w`` neighbouring grams the smallest is kept, the rightmost
on ties; windows at both ends hold what is there, so a text keeps its first and
its last gram.  So any ``w + k - 1`` units that two texts share give both the
same gram, and two texts that begin alike share one at any length.  A gram is one
long: 32 hash bits over 31 bits of the reversed place, which makes "smallest, then
rightmost" a plain minimum, and that over a window is built from windows of half its size.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

K, W = 3, 8
# Thai to Lao, Burmese, Khmer, kana, ideographs
_UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF"
UNITS = rf"[{_UNSPACED}]|[^\x20\x09-\x0D{_UNSPACED}]{{1,4}}"
_PLACES = (1 << 31) - 1


def grams(text: Column, k: int = K) -> Column:
    """One long per unit of the text: it and up to ``k - 1`` units before it; no unit no gram."""
    hashes = F.transform(F.regexp_extract_all(text, F.lit(UNITS), F.lit(0)), lambda x: F.xxhash64(x))

    def gram(h: Column) -> Column:
        at = lambda i, j: F.get(h, i - (k - 1 - j))  # noqa: E731  null before the first unit: not hashed
        packed = lambda i: F.shiftleft(
            F.shiftrightunsigned(F.xxhash64(*(at(i, j) for j in range(k))), 32), 31).bitwiseOR(F.lit(_PLACES) - i)
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(h) - 1), packed))

    return _let(hashes, gram)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _halves(size: int) -> list[int]:
    """Shifts that widen a window from 1 to ``size``, each at most the width reached so far."""
    shifts, width = [], 1
    while width < size:
        shifts.append(min(width, size - width))
        width += shifts[-1]
    return shifts


def winnowed(packed: Column, w: int = W) -> Column:
    """The distinct minima of all windows of ``w`` grams, cut off at both ends of the text, in order of place."""

    def widen(shifts: list[int]):
        if not shifts:
            return F.array_distinct
        shift = shifts[0]

        def use(m: Column) -> Column:
            later = F.slice(m, F.lit(shift + 1), F.greatest(F.size(m) - shift, F.lit(0)))
            least = F.zip_with(F.slice(m, F.lit(1), F.size(later)), later, lambda a, b: F.least(a, b))
            return _let(least, widen(shifts[1:]))

        return use

    beyond = F.array_repeat(F.lit((1 << 63) - 1), w - 1)  # at least as large as any gram: no window keeps it
    return _let(packed, lambda m: F.when(F.size(m) == 0, m).otherwise(_let(F.concat(beyond, m, beyond), widen(_halves(w)))))


def hashes_of(prints: Column) -> Column:
    return F.transform(prints, lambda x: F.shiftrightunsigned(x, 31))


def places_of(prints: Column) -> Column:
    """Places (from 0) of the last units of the kept grams."""
    return F.transform(prints, lambda x: F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES)))


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "prints", k: int = K, w: int = W) -> DataFrame:
    """Adds the kept grams of ``text`` (null counts as empty): read them by ``hashes_of`` and ``places_of``."""
    return df.withColumn(out, winnowed(grams(F.coalesce(F.col(text), F.lit("")), k), w))


def digest(prints: Column) -> Column:
    """The kept hashes in order as hexadecimal text, eight digits each."""
    return F.array_join(F.transform(hashes_of(prints), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct hashes of either side that both have; two empty sides are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def with_next(df: DataFrame, order: str, carried: list[str], derive=lambda d: d, derived: tuple[str, ...] = (),
              per_bucket: int = 2000) -> DataFrame:
    """Each row with the ``carried`` and ``derived`` columns of the next row by ``order`` as ``next_*``; the last gets the first.

    The order column is cut into ranges at quantiles.  Every range also holds a
    copy of the first row of the range after it, so one shuffle by range is
    enough and no task needs another's rows.  ``derive`` adds columns after that
    shuffle.  Ties are ordered by the carried columns, null orders come first.
    """
    rows = df.count()
    buckets = max(1, min(1 << 15, -(-rows // per_bucket)))
    place = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    cuts = df.where(F.col(order).isNotNull()).select(
        F.percentile_approx(order, [i / buckets for i in range(1, buckets)] or [0.5], 20 * buckets)).first()[0] or []
    cuts = sorted({float(c) for c in cuts})
    if cuts and buckets > 1:
        splits = [float("-inf"), *cuts, float("inf")]
        marked = Bucketizer(splits=splits, inputCol="_place", outputCol="_b").transform(df.withColumn("_place", place))
        marked = marked.withColumn("_b", F.col("_b").cast("int")).drop("_place")
    else:
        marked = df.withColumn("_b", F.lit(0))
    # first row of every range: at most 32,768 rows
    lowest = marked.groupBy("_b").agg(
        F.min(order).alias("_low"), F.max(F.col(order).isNull()).alias("_open"))
    first_of = F.broadcast(lowest.select(F.col("_b").alias("_fb"), F.when(~F.col("_open"), F.col("_low")).alias("_low")))
    firsts = (
        marked.join(first_of, (F.col("_b") == F.col("_fb")) & F.col(order).eqNullSafe(F.col("_low")))
        .groupBy("_b").agg(F.min(F.struct(order, *carried)).alias("_row"))
    )
    before = F.lag("_b").over(Window.orderBy("_b"))
    # the range before; before the first one is the last
    targets = lowest.select(F.col("_b").alias("_fb"), F.coalesce(before, F.max("_b").over(Window.partitionBy())).alias("_to"))
    ghosts = firsts.join(F.broadcast(targets), F.col("_b") == F.col("_fb")).select(
        F.col("_to").alias("_b"), F.col("_row"), F.lit(1).alias("_ghost"))
    ghosts = ghosts.select("_b", "_ghost", F.col(f"_row.{order}").alias(order), *[F.col(f"_row.{c}").alias(c) for c in carried])
    laid = derive(marked.withColumn("_ghost", F.lit(0)).unionByName(ghosts, allowMissingColumns=True).repartition("_b"))
    following = Window.partitionBy("_b").orderBy(
        "_ghost", F.col(order).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in carried])
    return (
        laid.withColumns({f"next_{c}": F.lead(c).over(following) for c in (*carried, *derived)})
        .where(F.col("_ghost") == 0).drop("_ghost", "_b")
    )


def edited(text: Column, following: Column) -> Column:
    """The last quarter (rounded down) of the code points replaced by as many first ones of another text."""
    cut = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut))
