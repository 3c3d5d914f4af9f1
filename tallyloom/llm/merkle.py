"""Merkle manifest of a table by butterfly exchange.

Every group of rows (a source) is a tree of fixed fan-out over its rows in order,
and the subroots of the groups are the leaves of one more tree of the same kind.

Rows are cut into aligned blocks of ``fanout ** LEVELS`` leaves; a block builds its
own subtree in one task.  Then the blocks swap what they have, as in a butterfly
network: in round r, blocks that differ in digit r of their number only (base
fan-out) meet, each hands over the subtree root it holds and all of them hash
the common ancestor.  After log(blocks) rounds every block holds the root *and* has
met all siblings on its way up, so no proof has to be handed down.  Where the last
node of a round stands for fewer blocks than its siblings, its blocks also serve
the partners that would be missing.  A round moves one digest per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.places import met, placed
from tallyloom.operators.lookup import small
from tallyloom.session import settled

FANOUT, LEVELS = 3, 6
_STEP = "struct<before:string,after:string>"
NO_STEPS = f"array<{_STEP}>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def leaf_digest(columns: Sequence[Column | str]) -> Column:
    """Digest of a row: per column ``-`` if null, else its UTF-8 length, ``:`` and its text."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def folded(leaf: Column, proof: Column) -> Column:
    """Root that follows from a leaf and its proof (steps from the leaf up)."""
    return F.aggregate(proof, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def _height(n: Column, fanout: int) -> Column:
    """Levels above n nodes until one is left."""
    powers = [fanout**i for i in range(63) if fanout**i < 2**62]
    return F.size(F.filter(F.array(*[F.lit(p) for p in powers]), lambda p: p < n))


def _parents(nodes: Column, fanout: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(fanout))
    return F.transform(starts, lambda i: digest(F.array_join(F.slice(nodes, i, fanout), "")))


def _step(nodes: Column, place: Column, fanout: int) -> Column:
    """Siblings before and after a node of one level."""
    at = (place % fanout).cast("int")
    run = (place - at).cast("int") + 1
    return F.struct(
        F.array_join(F.slice(nodes, run, at), "").alias("before"),
        F.array_join(F.slice(nodes, run + at + 1, F.lit(fanout - 1) - at), "").alias("after"))


def _blocks(leaves: DataFrame, group: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """One row per aligned block: its leaves in order and the nodes of each level, the block's own root last."""
    span = fanout**levels
    rows = leaves.select(
        *group, "n", F.expr(f"pos div {span}").alias("block"), F.struct("pos", "leaf", "row").alias("item"))
    blocks = rows.groupBy(*group, "block").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("item")).alias("items"))
    blocks = blocks.withColumn("blocks", F.expr(f"(n + {span - 1}) div {span}"))
    up = F.when(F.col("blocks") > 1, F.lit(levels)).otherwise(_height(F.col("n"), fanout))
    return blocks.withColumn("tree", F.aggregate(
        F.sequence(F.lit(0), F.lit(levels - 1)), F.array(F.col("items.leaf")),
        lambda tree, i: F.when(i < up, F.concat(tree, F.array(_parents(F.element_at(tree, -1), fanout)))).otherwise(tree)))


def _exchange(held: DataFrame, group: Sequence[str], fanout: int, r: int) -> DataFrame:
    """Round r: ``block, blocks, hash, path`` with the hash of the next ancestor and one more step."""
    width = fanout**r
    node, low = F.expr(f"block div {width}"), F.expr(f"block % {width}")
    nodes = F.expr(f"(blocks + {width - 1}) div {width}")
    spare = F.col("blocks") - (nodes - 1) * width  # blocks of the last node
    lone = (node == nodes - 1) & (node % fanout != 0) & (spare < width)
    # the last node's blocks also meet the partners of its siblings whose own counterpart does not exist
    slots = F.when(nodes == 1, F.array(low)).when(lone, F.sequence(low, F.lit(width - 1), spare)).otherwise(F.array(low))
    sent = held.select(
        *group, F.when(nodes == 1, F.col("block")).otherwise(F.expr(f"block div {width * fanout}")).alias("_meet"),
        F.explode(slots).alias("_slot"), low.alias("_low"), nodes.alias("_nodes"),
        F.struct((node % fanout).alias("digit"), "hash").alias("_node"), F.struct("block", "blocks", "hash", "path").alias("_own"))
    met = sent.groupBy(*group, "_meet", "_slot").agg(
        F.first("_nodes").alias("_nodes"), F.sort_array(F.collect_set("_node")).alias("_run"),
        F.collect_list(F.when(F.col("_slot") == F.col("_low"), F.col("_own"))).alias("_owners"))
    each = met.select(*group, "_nodes", "_run", F.explode("_owners").alias("_own"))
    digit = F.expr(f"_own.block div {width} % {fanout}")
    side = lambda keep: F.array_join(F.transform(F.filter("_run", keep), lambda x: x["hash"]), "")
    step = F.struct(side(lambda x: x["digit"] < digit).alias("before"), side(lambda x: x["digit"] > digit).alias("after"))
    up = F.col("_nodes") > 1
    return each.select(
        *group, F.col("_own.block").alias("block"), F.col("_own.blocks").alias("blocks"),
        F.when(up, digest(F.array_join("_run.hash", ""))).otherwise(F.col("_own.hash")).alias("hash"),
        F.when(up, F.concat("_own.path", F.array(step))).otherwise(F.col("_own.path")).alias("path"))


def trees(leaves: DataFrame, group: Sequence[str], fanout: int = FANOUT, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Trees over ``leaves`` (``leaf, row, pos, n`` and the group): blocks with their rows, and what each block learned.

    The second table holds ``block, hash, path`` of each block: root of its group's tree and
    the steps from the block's own root up to it.
    """
    blocks = settled(_blocks(leaves, group, fanout, levels))
    held = blocks.select(
        *group, "block", "blocks", F.element_at(F.element_at("tree", -1), 1).alias("hash"), F.array().cast(NO_STEPS).alias("path"))
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    r = 0
    while fanout**r < most:
        held = _exchange(held, group, fanout, r)
        r += 1
    return blocks, held.drop("blocks")


def _proofs(blocks: DataFrame, learned: DataFrame, group: Sequence[str], fanout: int, keep: Sequence[str] = ()) -> DataFrame:
    """``row, leaf, proof, root`` and the group of every leaf: steps inside its block, then those of the block."""
    item = met(blocks, learned, [*group, "block"]).select(*group, "hash", "path", *keep, "tree", F.posexplode("items").alias("_at", "_item"))
    levels = F.sequence(F.lit(0), F.size("tree") - 2)
    inner = F.when(F.size("tree") > 1, F.transform(levels, lambda i: _step(
        F.element_at("tree", i + 1), F.floor(F.col("_at") / F.pow(F.lit(fanout), i)).cast("long"), fanout)))
    return item.select(
        *group, F.col("_item.row").alias("row"), F.col("_item.leaf").alias("leaf"), F.col("hash").alias("root"), *keep,
        F.concat(F.coalesce(inner, F.array().cast(NO_STEPS)), "path").alias("proof"))


def manifest(rows: DataFrame, columns: Sequence[str], group: str, key: str, carry: Sequence[Column] = (),
             fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``key, group, leaf, subroot, root, proof`` of every row, and ``carry``.

    ``columns`` make the leaf, ``group`` names a row's tree (null is a group, and the
    first one), ``key`` orders a group's rows: nulls first, then ascending; rows with one
    key go by their leaf, so equal rows may stand in any order.  ``proof`` holds a step per
    level, from the leaf up through the subroot to the root, with the siblings before and
    after as text; a level where a node is alone has empty sides.  An empty table gives an
    empty table.  Other columns are not read; the results' names never clash with them.
    Group values order by their UTF-8 bytes (text) or value.
    """
    leaves = settled(rows.select(
        F.col(group).alias("grp"), F.col(key).alias("key"), leaf_digest(columns).alias("leaf"), *[c for c in carry]))
    extra = [c for c in leaves.columns if c not in ("grp", "key", "leaf")]
    items = placed(leaves, ["grp"], ["key", "leaf"]).select("grp", "n", "pos", "leaf", F.struct("key", *extra).alias("row"))
    blocks, learned = trees(items, ["grp"], fanout, levels)
    learned = settled(learned)
    # the subroots are leaves themselves
    tops = settled(learned.where("block = 0").select(F.lit(0).alias("all"), "grp", F.col("hash").alias("leaf")))
    above = placed(tops, ["all"], ["grp"]).select("all", "n", "pos", "leaf", F.struct("grp").alias("row"))
    upper = _proofs(*trees(above, ["all"], fanout, levels), ["all"], fanout).select(
        F.col("row.grp").alias("grp"), F.col("root").alias("top"), F.col("proof").alias("rest"))
    upper = small(settled(upper))
    found = _proofs(blocks, met(learned, upper, ["grp"]), ["grp"], fanout, keep=["top", "rest"])
    return found.select(
        F.col("row.key").alias(key), F.col("grp").alias(group), "leaf", F.col("root").alias("subroot"), F.col("top").alias("root"),
        F.concat("proof", "rest").alias("proof"), *[F.col(f"row.{c}").alias(c) for c in extra])
