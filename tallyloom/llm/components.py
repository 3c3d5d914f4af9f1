"""Connected components over a table of links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.session import settled


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum, to see whether a round changed anything."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b`` (longs); the root is the smallest node reachable.

    Alternates two rounds until nothing changes: every larger neighbour of a
    node is tied to its smallest neighbour, then every smaller one.  Chains
    shrink exponentially, a star stays a star of the same size.  Smallest
    neighbours are aggregated map-side and joined back, so a node with very many
    links is split by the adaptive skew join.  Links from a node to itself and
    repeated links do no harm; null ends are dropped.  Rounds are cut by checkpoints.
    """
    links = settled(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(links)
    while mark[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        large = settled(large)
        # every link now points from the larger to the smaller end
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
            .select("l.a", "l.b").where("a <> b").distinct()
        )
        links = settled(small)
        was, mark = mark, _mark(links)
        if was == mark:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
