"""Splits and survey samplers, exact in size and repeatable on any layout.

A row's place in a random order is its keyed draw (ties by key).  The n-th
lowest draw is found from a histogram of the draws' leading bits (at most 65,536
rows, summed per task before the shuffle) plus the one bucket that holds it, so
no sampler sorts the whole table or moves it to one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.hashing import BUCKETS, SPAN, bucket_of, draw, drawn_below, fast_uniform, uniform
from tallyloom.operators.lookup import small
from tallyloom.operators.ordered import row_index, running_total
from tallyloom.session import settled

_BEFORE = (Window.unboundedPreceding, -1)
COPIES_AT_ONCE = 10_000
DRAWS_AT_ONCE = 2_000_000  # draws of one task


# -- splits -------------------------------------------------------------------

def with_split(df: DataFrame, key: str, weights: Sequence[float], seed: int | str = 13, out: str = "split") -> DataFrame:
    """Number of the part (0, 1, ...) each row falls in, with chances by weight."""
    whole = float(sum(weights))
    u, upper, label = uniform(key, seed=seed), 0.0, F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        upper = sum(weights[: i + 1]) / whole
        label = F.when(u < F.lit(upper), F.lit(i)).otherwise(label)
    return df.withColumn(out, label)


def weighted_split(df: DataFrame, key: str, weights: Sequence[float], seed: int | str = 13) -> list[DataFrame]:
    """Disjoint parts that together are the input."""
    marked = with_split(df, key, weights, seed, "_split")
    return [marked.where(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def hold_out(df: DataFrame, key: str, share: float = 0.2, seed: int | str = 13) -> Column:
    """True for the held-out rows (about ``share`` of them); training rows are the rest."""
    return uniform(key, seed=seed) < F.lit(share)


def mini_batch(df: DataFrame, key: str, size: int, total: int | Column, iteration: int | Column = 0,
               seed: int | str = 13, fast: bool = False) -> DataFrame:
    """Bernoulli batch of expected ``size`` rows for one iteration."""
    total = total if isinstance(total, Column) else F.lit(float(total))
    step = iteration if isinstance(iteration, Column) else F.lit(iteration)
    u = (fast_uniform if fast else uniform)(key, step, seed=seed)
    return df.where(u < F.lit(float(size)) / total)


def cut_rows(df: DataFrame, drawn: Column, key: str, places: Callable[[int], Sequence[int]]) -> list[tuple | None]:
    """The (draw, key) pairs at given places of the random order; None beyond the last row.

    ``places`` gets the row count and names the places.  Two narrow scans: one
    tallies the leading bits, one ranks the buckets that hold a place (each about
    1/65,536 of the rows).  A pair per place comes to the driver.
    """
    keyed = df.select(drawn.alias("_u"), F.col(key).alias("_k")).withColumn("_b", bucket_of(F.col("_u")))
    tally = settled(keyed.groupBy("_b").agg(F.count("*").alias("_n")))
    wanted = list(places(tally.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(*_BEFORE)), F.lit(0))
    place = F.explode(F.array(*[F.lit(p).cast("bigint") for p in wanted]))
    holding = (
        tally.select("_b", "_n", before.alias("_before"))
        .select("*", place.alias("_at"))
        .where((F.col("_before") < F.col("_at")) & (F.col("_at") <= F.col("_before") + F.col("_n")))
        .collect()
    )
    if not holding:
        return [None] * len(wanted)
    ranked = keyed.where(F.col("_b").isin([r["_b"] for r in holding])).withColumn(
        "_place", F.row_number().over(Window.partitionBy("_b").orderBy("_u", "_k")))
    pick = [(F.col("_b") == r["_b"]) & (F.col("_place") == r["_at"] - r["_before"]) for r in holding]
    rows = {(r["_b"], r["_place"]): (r["_u"], r["_k"]) for r in ranked.where(reduce(or_, pick)).collect()}
    found = {r["_at"]: rows[(r["_b"], r["_at"] - r["_before"])] for r in holding}
    return [found.get(p) for p in wanted]


def _up_to(drawn: Column, key: str, cut: tuple | None) -> Column:
    """True for rows at or before the cut row in random order (all rows when there is no such row)."""
    if cut is None:
        return F.lit(True)
    u, k = F.lit(cut[0]), F.lit(cut[1])
    return (drawn < u) | ((drawn == u) & (F.col(key) <= k))


def three_way_split(df: DataFrame, key: str, shares: Sequence[float] = (0.7, 0.15), seed: int | str = 13,
                    out: str = "split") -> DataFrame:
    """Exact split of a shuffled order: the first ``int(.7 N)`` rows, the next ``int(.15 N) + 1``, the rest.

    Two cut rows are looked up; labelling is then a comparison without a shuffle.
    """
    drawn = draw(key, seed=seed)

    def places(n: int) -> list[int]:
        first = int(shares[0] * n)
        return [first, first + int(shares[1] * n) + 1]

    train, validation = cut_rows(df, drawn, key, places)
    # no row stands at place 0: nothing to train on
    in_train = F.lit(False) if train is None else _up_to(drawn, key, train)
    label = F.when(in_train, "train").when(_up_to(drawn, key, validation), "validation").otherwise("test")
    return df.withColumn(out, label)


def shuffled(df: DataFrame, key: str, seed: int | str = 13) -> DataFrame:
    """All rows in a repeatable random order (range-partitioned sort)."""
    return df.orderBy(draw(key, seed=seed), key)


def shuffled_places(df: DataFrame, key: str, seed: int | str = 13, out: str = "place") -> DataFrame:
    """Every row's place (from 1) in the same random order."""
    return row_index(df.withColumn("_u", draw(key, seed=seed)), ["_u", key], out).drop("_u")


# -- samples of exact size ------------------------------------------------------

def simple_random(df: DataFrame, key: str, n: int, seed: int | str = 13) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows when there are fewer)."""
    drawn = draw(key, seed=seed)
    if n <= 0:
        return df.limit(0)
    return df.where(_up_to(drawn, key, cut_rows(df, drawn, key, lambda rows: [n])[0]))


def lowest_per_stratum(df: DataFrame, strata: str, key: str, drawn: Column, sizes: DataFrame) -> DataFrame:
    """Rows with the lowest draws, ``sizes(stratum, size)`` of each stratum.

    Draws are tallied per stratum and leading bits; rows beyond the bucket that
    fills the quota are dropped before anything is ranked, and ranking is split
    by bucket, so a stratum with a third of all rows is spread over many tasks.
    """
    marked = df.withColumn("_u", drawn).withColumn("_b", bucket_of(F.col("_u")))
    tallied = marked.groupBy(strata, "_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(strata).orderBy("_b").rowsBetween(*_BEFORE)), F.lit(0))
    quota = sizes.select(strata, F.col("size").alias("_size")).where(F.col("size") > 0)
    edges = (
        tallied.select(strata, "_b", before.alias("_before"))
        .join(quota, strata)
        .where(F.col("_before") < F.col("_size"))
        .groupBy(strata)
        .agg(F.max(F.struct("_b", (F.col("_size") - F.col("_before")).alias("_need"))).alias("_edge"))
    )
    # one row per stratum: kept, counted and broadcast when few, so a hot stratum is not shuffled as one key
    edges = small(settled(edges))
    near = marked.join(edges, strata).where(F.col("_b") <= F.col("_edge._b"))
    place = F.row_number().over(Window.partitionBy(strata, "_b").orderBy("_u", key))
    return (
        near.withColumn("_place", place)
        .where((F.col("_b") < F.col("_edge._b")) | (F.col("_place") <= F.col("_edge._need")))
        .select(*df.columns)
    )


def proportional_sizes(df: DataFrame, strata: str, n: int) -> DataFrame:
    """``stratum, freq, size``: shares of ``n`` by frequency, whole numbers that add up to ``n``.

    Integer arithmetic: floor, then one more for the largest remainders (ties by name).
    """
    freq = settled(df.where(F.col(strata).isNotNull()).groupBy(strata).agg(F.count("*").alias("freq")))
    total = freq.agg(F.coalesce(F.sum("freq"), F.lit(0))).first()[0]
    shared = freq.withColumns({
        "_base": F.expr(f"cast((cast({n} as decimal(19,0)) * freq) div {total} as bigint)"),
        "_rest": F.expr(f"cast((cast({n} as decimal(19,0)) * freq) % {total} as bigint)")})
    left = shared.agg((F.lit(n) - F.sum("_base")).alias("n")).scalar()
    # at most n strata can get one more, so only n rows are ranked
    lifted = (
        shared.orderBy(F.desc("_rest"), strata).limit(n)
        .select(strata, F.row_number().over(Window.orderBy(F.desc("_rest"), strata)).alias("_rank"))
        .where(F.col("_rank") <= left)
        .select(strata, F.lit(1).cast("bigint").alias("_more"))
    )
    return shared.join(lifted, strata, "left").select(
        strata, "freq", (F.col("_base") + F.coalesce("_more", F.lit(0))).alias("size")
    )


def stratified(df: DataFrame, strata: str, key: str, n: int, seed: int | str = 13) -> DataFrame:
    """Simple random sample in each stratum, sizes proportional to frequency and adding up to ``n``."""
    return lowest_per_stratum(df, strata, key, draw(key, seed=seed), proportional_sizes(df, strata, n))


def repeated_samples(df: DataFrame, key: str, n: int = 50, times: int = 30, seed: int | str = 13) -> DataFrame:
    """``times`` independent samples of ``n`` rows, numbered by ``sample_id`` from 1.

    A row only becomes a row of those samples for which its draw is low enough to
    be among the first ``n`` with near certainty; the few that pass are ranked
    exactly.  Should a sample fall short, all are drawn again with a wider bound.
    Rows are dealt to tasks by their number of draws, however few tasks read them.
    """
    rows, wanted = df.count(), n
    dealt = df.repartition(-(-rows * times // DRAWS_AT_ONCE)) if rows * times > DRAWS_AT_ONCE else df
    size = n + 6 * math.sqrt(n) + 20
    while True:
        bound = SPAN if size >= rows else int(SPAN * size / rows)
        drawn = dealt.withColumn("sample_id", F.explode(F.sequence(F.lit(1), F.lit(times))))
        near = settled(drawn.where(drawn_below(bound, "sample_id", key, seed=seed)))
        held = near.groupBy("sample_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(wanted, rows)).count()
        if size >= rows or held == times:
            break
        size *= 2
    sizes = df.sparkSession.range(1, times + 1).select(
        F.col("id").cast("int").alias("sample_id"), F.lit(n).cast("bigint").alias("size")
    )
    return lowest_per_stratum(near, "sample_id", key, draw(F.col("sample_id"), F.col(key), seed=seed), sizes)


def bootstrap(df: DataFrame, order: Sequence[str], seed: int | str = 13, expand: bool = False) -> DataFrame:
    """N draws with replacement.  ``times`` says how often each drawn row came up; ``expand`` repeats the rows.

    Row i makes draw i, so the draws need no table of their own and are counted
    per target before the join.
    """
    indexed = row_index(df, order, "_i")
    rows = indexed.agg(F.count("*").alias("n")).scalar()
    target = (F.floor(uniform("_i", seed=seed) * rows) + 1).cast("bigint")
    drawn = indexed.select(target.alias("_i")).groupBy("_i").agg(F.count("*").alias("times"))
    out = indexed.join(drawn, "_i").drop("_i")
    if expand:
        out = out.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("col")
    return out


def systematic(df: DataFrame, order: Sequence[str | Column], target: int = 20, start: int | None = None,
               seed: int | str = 13) -> DataFrame:
    """Every k-th row from a start in 1..k, with k = ceil(N / target): about ``target`` rows."""
    indexed = row_index(df, order, "_i")
    step = F.ceil(indexed.agg(F.count("*").alias("n")).scalar() / F.lit(target)).cast("bigint")
    first = F.lit(start) if start is not None else (F.floor(uniform(F.lit("start"), seed=seed) * step) + 1)
    return indexed.where((F.col("_i") >= first) & (F.pmod(F.col("_i") - first, step) == 0)).drop("_i")


# -- unequal probabilities --------------------------------------------------------

def inclusion_probabilities(df: DataFrame, size: str, n: int, out: str = "pik") -> DataFrame:
    """Probabilities proportional to ``size`` that add up to ``n``, none above 1.

    Rows that reach 1 are fixed there and the rest is rescaled until no new row
    reaches 1.  A round is one filtered aggregate of the size column (the bound is
    pushed to the scan); rows capped once stay capped, so the rounds end.
    """
    sized = df.where(F.col(size) > 0)
    whole, rows = sized.agg(F.coalesce(F.sum(F.col(size).cast("double")), F.lit(0.0)), F.count("*")).first()
    if n >= rows:
        return df.withColumn(out, F.when(F.col(size) > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    fixed, fixed_sum = 0, 0.0
    while True:
        bound = (whole - fixed_sum) / (n - fixed)
        count, total = (
            df.where(F.col(size) >= F.lit(bound))
            .agg(F.count("*"), F.coalesce(F.sum(F.col(size).cast("double")), F.lit(0.0)))
            .first()
        )
        if count <= fixed or count >= n:
            break
        fixed, fixed_sum = count, total
    c = F.col(size).cast("double")
    return df.withColumn(
        out,
        F.when(c <= 0, F.lit(0.0)).when(c >= bound, F.lit(1.0))
        .when(c > 0, F.lit(float(n - fixed)) * c / F.lit(whole - fixed_sum)).otherwise(F.lit(0.0)),
    )


def pps_systematic(df: DataFrame, order: Sequence[str], pik: str = "pik", u: float | None = None,
                   seed: int | str = 13) -> DataFrame:
    """Systematic draw with the given probabilities: a row is taken where the running sum passes ``(u + j) * step``.

    Rows with probability 1 are always taken, rows with 0 never.  The others are
    summed as decimals, so the running sum does not depend on the order of
    additions, and however small they are each has its share.  ``step`` is 1, or
    what makes the sum a whole number of steps if it is one but for rounding, so
    exactly that many rows are drawn.
    """
    certain = df.where(F.col(pik) >= 1)
    shares = df.where((F.col(pik) > 0) & (F.col(pik) < 1)).withColumn("_p", F.col(pik).cast("decimal(28,20)"))
    whole = float(shares.agg(F.coalesce(F.sum("_p"), F.lit(0).cast("decimal(38,20)"))).first()[0])
    step = whole / round(whole) if round(whole) and abs(whole - round(whole)) < 1e-6 else 1.0
    start = F.lit(float(u)) if u is not None else uniform(F.lit("start"), seed=seed)
    summed = running_total(shares, order, "_p", "_cum")
    # marks below a running sum; a row's lower sum is exactly the upper one of the row before
    marks = lambda x: F.ceil(F.round(x.cast("double") / F.lit(step) - start, 9))
    taken = marks(F.col("_cum")) > marks(F.col("_cum") - F.col("_p"))
    return summed.where(taken).select(*df.columns).unionByName(certain)


# -- balancing --------------------------------------------------------------------

def upsample(df: DataFrame, label: str, key: str, seed: int | str = 13) -> DataFrame:
    """Repeat the rows of smaller classes until every class is as large as the largest.

    Whole copies come from ``explode``; what is missing after them is a sample of
    the class without replacement.
    """
    freq = settled(df.groupBy(label).agg(F.count("*").alias("_n")))
    largest_n = freq.agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0]
    largest = F.lit(largest_n).cast("bigint")
    plan = freq.select(label, F.expr(f"{largest_n} div _n").alias("_copies"), F.pmod(largest, F.col("_n")).alias("size"))
    marked = df.join(small(plan.select(label, "_copies")), label)
    few = marked.where(F.col("_copies") <= COPIES_AT_ONCE).withColumn("_times", F.col("_copies"))
    # very many copies of a row are made by many tasks: first in blocks, then row by row
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {COPIES_AT_ONCE}")))
    many = (
        marked.where(F.col("_copies") > COPIES_AT_ONCE).withColumn("_block", block)
        .withColumn("_times", F.least(F.lit(COPIES_AT_ONCE), F.col("_copies") - F.col("_block") * COPIES_AT_ONCE))
        .repartition(key, "_block").drop("_block")
    )
    whole = few.unionByName(many).select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).drop("col")
    rest = lowest_per_stratum(df, label, key, draw(key, seed=seed), plan.select(label, "size"))
    return whole.unionByName(rest)


def separability(df: DataFrame, score: str, label: str, key: str) -> DataFrame:
    """Sort scores and labels independently and pair them by rank."""
    scores = row_index(df.select(score, key), [score, key], "rank").select("rank", score)
    labels = row_index(df.select(label, key), [label, key], "rank").select("rank", label)
    return scores.join(labels, "rank")


__all__ = [
    "BUCKETS", "with_split", "weighted_split", "hold_out", "mini_batch", "cut_rows", "three_way_split", "shuffled", "shuffled_places",
    "simple_random", "lowest_per_stratum", "proportional_sizes", "stratified", "repeated_samples", "bootstrap",
    "systematic", "inclusion_probabilities", "pps_systematic", "upsample", "separability",
]
