"""Near-duplicate texts by an LSH forest of MinHash signatures.

A document is its set of distinct word shingles.  A tree of the forest orders all
distinct sets by a signature of ``DEPTH`` MinHash values, and sets that are alike stand
next to each other where their longest common prefix is long.  All neighbours that
share ``BASE`` values (a region) are candidates: two sets of similarity 0.8 share none
in any of ``TREES`` trees with probability 1e-7.

How deep a region is searched depends on it, and goes on until nothing is left:

1. in the first trees every set meets its neighbours of the longest common prefix, so
   that a crowded region of copies is one component at once,
2. then, in all trees, whatever shares ``BASE`` values and still lies in different components meets:
   the component that fills a region is a family, the region's other sets visit all of it.

Candidates whose sizes cannot reach the similarity, or whose sketches (a bit of
``SKETCH`` values each) differ in more bits than sets of that similarity ever do, are
left out.  The rest is confirmed on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from tallyloom.llm.arrow import map_arrow
from tallyloom.llm.components import connected
from tallyloom.llm.places import met, written
from tallyloom.operators.lookup import small
from tallyloom.session import settled

SHINGLE = 2
TREES, BASE, DEPTH, FIRST = 40, 5, 7, 8
SKETCH = 128
#: Sets of similarity 0.8 agree in a sketch bit with probability 0.9; 34 or more of 128 bits differ once in 4e7.
MOST_BITS = 33
#: Shingles of the sets that a probe is compared with at once.
LOT = 400_000
_SLICE = 2048  # shingles hashed by all functions at once
_WORDS = 1 << 18  # words whose hashes a worker keeps

_draw = np.random.default_rng(12)
_MULTIPLIERS = _draw.integers(1 << 62, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _draw.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: the golden ratio in 64 bits, odd


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_set(text: bytes, words: dict[bytes, int], shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; one of all words if there are fewer."""
    said = text.lower().split()
    if not said:
        return np.empty(0, np.uint64)
    if len(words) > _WORDS:
        words.clear()
    for word in said:
        if word not in words:
            words[word] = xxh3_64_intdigest(word)
    hashes = np.fromiter(map(words.__getitem__, said), np.uint64, len(said))
    size = min(shingle, len(said))
    out = np.full(len(said) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mixed(out + hashes[i : len(said) - size + 1 + i])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of every hash function over a set (32 bits each)."""
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), _SLICE):
        values = shingles[at : at + _SLICE, None] * _MULTIPLIERS + _ADDENDS
        np.minimum(least, (values >> np.uint64(32)).astype(np.uint32).min(0), out=least)
    return least


def _set_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        for batch in batches:
            sizes, prints, keys, deeps, sketches = [], [], [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py() or b"", words, shingle)
                sizes.append(len(found))
                prints.append(xxh3_64_intdigest(found.tobytes()))
                tree = signature(found).reshape(TREES, DEPTH)
                place = np.full(TREES, 1, np.uint64) + np.arange(TREES, dtype=np.uint64)
                for i in range(BASE):
                    place = _mixed(place + tree[:, i])
                keys.append(place)
                deeps.append(tree[:, BASE].astype(np.uint64) << np.uint64(32) | tree[:, BASE + 1])
                sketches.append(np.packbits(tree.ravel()[:SKETCH] & 1).view(np.uint64))
            lists = lambda arrays, width: pa.ListArray.from_arrays(
                pa.array(np.arange(len(arrays) + 1, dtype=np.int32) * width),
                pa.array(np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)), lists(keys, TREES),
                 lists(deeps, TREES), lists(sketches, 2)], ["id", "n", "fp", "keys", "deeps", "sketch"])
    return run


def _text_batches(shingle: int):
    """Rows ``fp, text`` whose text has the set ``fp``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        for batch in batches:
            prints = [xxh3_64_intdigest(shingle_set(t.as_py() or b"", words, shingle).tobytes()) for t in batch.column(1)]
            yield batch.filter(pa.array(np.array(prints, np.uint64).view(np.int64) == batch.column(0).to_numpy(zero_copy_only=False)))
    return run


def _neighbour_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, deep, fp, comp`` in a tree's order to candidates: each with the row before it in its region."""
    before = None
    for batch in batches:
        key, _, fp, comp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if before is not None:
            key, fp, comp = (np.concatenate([[b], c]) for b, c in zip(before, (key, fp, comp)))
        if len(key):
            before = key[-1], fp[-1], comp[-1]
        hit = (key[1:] == key[:-1]) & (comp[1:] != comp[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(fp[:-1][hit]), pa.array(fp[1:][hit])], ["a", "b"])


def _confirmed(limit: float, shingle: int):
    """Pairs of texts to those pairs whose sets are alike enough."""
    share = round(limit * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        last: tuple[int, np.ndarray] = (0, np.empty(0, np.uint64))
        for batch in batches:
            a, b = [], []
            for x, y, one, two in zip(*(c.to_pylist() for c in batch.columns)):
                if last[0] != y or not len(last[1]):
                    last = y, shingle_set(two, words, shingle)
                mine = shingle_set(one, words, shingle)
                both = len(np.intersect1d(mine, last[1], assume_unique=True))
                if 100 * both >= share * (len(mine) + len(last[1]) - both):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _visits(limit: float, shingle: int):
    """Lots, each as its sets and then the probes that visit it, to links: none twice between what is linked here."""
    share = round(limit * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        lot, prints, sets, index = None, [], [], None
        for batch in batches:
            a, b = [], []
            for family, number, visits, fp, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (family, number) != lot:
                    lot, prints, sets, index, roots = (family, number), [], [], None, {}
                mine = shingle_set(text, words, shingle)
                if not visits:
                    prints.append(fp)
                    sets.append(mine)
                    continue
                if index is None:  # whose shingles are which, in the order of the shingles
                    sizes = np.array([len(x) for x in sets])
                    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                    order = np.argsort(values, kind="stable")
                    index = values[order], np.repeat(np.arange(len(sets)), sizes)[order], sizes
                values, owner, sizes = index
                start, stop = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
                count = stop - start
                at = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                both = np.bincount(owner[at], minlength=len(sizes))
                for j in np.flatnonzero(100 * both >= share * (len(mine) + sizes - both)):
                    one, two = _root(roots, fp), _root(roots, prints[j])
                    if one != two:
                        roots[one] = two
                        a.append(fp)
                        b.append(prints[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _root(roots: dict[int, int], node: int) -> int:
    while roots.get(node, node) != node:
        roots[node] = node = roots.get(roots[node], roots[node])
    return node


class _Forest:
    """Distinct sets, their places in the trees, and the links confirmed so far."""

    def __init__(self, rows: DataFrame, sets: DataFrame, limit: float, shingle: int):
        self.sets, self.limit, self.shingle = sets, limit, shingle
        places = sets.select("fp", F.posexplode(F.arrays_zip("keys", "deeps")).alias("tree", "at")).select(
            "tree", F.col("at.keys").alias("key"), F.col("at.deeps").alias("deep"), "fp")
        # most regions hold one set: only their keys move
        crowded = places.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("key")
        self.places = settled(places.join(small(settled(crowded)), "key", "left_semi"))
        # texts only of sets that meet any other; ids may repeat, so the text itself tells its set
        wanted = settled(sets.select("fp", "id").join(self.places.select("fp").distinct(), "fp", "left_semi"))
        texts = met(rows, small(wanted), ["id"]).select("fp", "text")
        self.texts = written(map_arrow(texts, _text_batches(shingle), "fp bigint, text binary").dropDuplicates(["fp"]), "forest-texts")
        self.sizes = small(sets.select("fp", "n", "sketch"))
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None

    def placed(self) -> DataFrame:
        """Places with the component of each set so far."""
        if self.roots is None:
            return self.places.withColumn("comp", F.col("fp"))
        roots = small(self.roots.withColumnsRenamed({"node": "fp", "root": "_root"}))
        return self.places.join(roots, "fp", "left").withColumn("comp", F.coalesce("_root", "fp")).drop("_root")

    def meet(self, pairs: DataFrame) -> None:
        """Confirm candidates ``a, b`` and join what they link."""
        apart = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        sides = [self.sizes.withColumnsRenamed({"fp": side, "n": f"n_{side}", "sketch": f"sketch_{side}"}) for side in "ab"]
        could = apart.join(sides[0], "a").join(sides[1], "b").where(
            _sizes_fit("n_a", "n_b", self.limit) & (_differing(F.col("sketch_a"), F.col("sketch_b")) <= MOST_BITS))
        one, two = (self.texts.withColumnsRenamed({"fp": side, "text": f"text_{side}"}) for side in "ab")
        could = could.select("a", "b").join(one, "a").join(two, "b")
        links = map_arrow(could.select("a", "b", "text_a", "text_b"), _confirmed(self.limit, self.shingle), "a bigint, b bigint")
        links = settled(links if self.links is None else links.unionByName(self.links))
        self.links, self.roots = links, settled(connected(links))

    def neighbours(self, trees: int) -> DataFrame:
        """Every place with the one before it in its tree, from another component."""
        order = ["key", "deep", "fp"]
        rows = self.placed().where(f"tree < {trees}").select(*order, "comp")
        return map_arrow(rows.repartitionByRange(*order).sortWithinPartitions(*order), _neighbour_batches, "a bigint, b bigint")

    def families(self) -> DataFrame:
        """``family, fp, probe`` for whatever shares a region, lies in different components and may be alike.

        The family of a region is the component with most places in it.  All sets of a family's component are its
        members, the others of its regions are probes of it: every pair of a region that is left is then a member
        and a probe, or two probes, of one family.
        """
        rows = settled(self.placed())
        most = rows.groupBy("key", "comp").count().groupBy("key").agg(
            F.max_by("comp", F.struct("count", "comp")).alias("family"), F.count("*").alias("comps")).where("comps > 1").select("key", "family")
        rows = rows.join(small(settled(most)), "key")
        rows = settled(rows.join(self.sizes, "fp").select("key", "family", "fp", "comp", "n", "sketch"))
        # who has anybody to meet: one row each, however many those are
        other = rows.select(*[F.col(c).alias(f"{c}_") for c in rows.columns])
        near = _sizes_fit("n", "n_", self.limit) & (_differing(F.col("sketch"), F.col("sketch_")) <= MOST_BITS)
        meets = (F.col("key") == F.col("key_")) & (F.col("comp") != F.col("comp_")) & near
        probes = rows.where("comp <> family").join(other, meets, "left_semi").select("family", "fp").distinct()
        probes = settled(probes.withColumn("probe", F.lit(True)))
        comps = self.sets.select("fp") if self.roots is None else self.sets.select("fp").join(
            small(self.roots.withColumnRenamed("node", "fp")), "fp", "left")
        comps = comps.select(F.coalesce("root", "fp").alias("family"), "fp") if self.roots is not None else comps.select(F.col("fp").alias("family"), "fp")
        members = comps.join(small(settled(probes.select("family").distinct())), "family", "left_semi")
        return members.withColumn("probe", F.lit(False)).unionByName(probes)

    def meet_families(self) -> None:
        """Confirm probes against the members of their family and one another, and join what is linked.

        A family is dealt into lots of ``LOT`` shingles; a probe lies in one lot and visits all of them.
        """
        rows = settled(self.families())
        sized = rows.join(self.sizes.select("fp", "n"), "fp")
        lots = small(settled(sized.groupBy("family").agg(F.ceil(F.sum("n") / LOT).cast("int").alias("lots"))))
        own = F.pmod(F.col("fp"), F.col("lots")).cast("int")
        dealt = rows.join(lots, "family").select("family", "fp", F.explode(F.concat(
            F.array(F.struct(own.alias("lot"), F.lit(False).alias("visits"))),
            F.when(F.col("probe"), F.transform(F.sequence(F.lit(0), F.col("lots") - 1), lambda i: F.struct(i.alias("lot"), F.lit(True).alias("visits"))))
            .otherwise(F.array().cast("array<struct<lot:int,visits:boolean>>")))).alias("to"))
        dealt = dealt.select("family", "fp", "to.lot", "to.visits").join(self.texts, "fp")
        order = ["family", "lot", "visits"]
        met_in = dealt.select(*order, "fp", "text").repartition("family", "lot").sortWithinPartitions(*order, "fp")
        links = settled(map_arrow(met_in, _visits(self.limit, self.shingle), "a bigint, b bigint").unionByName(self.links))
        self.links, self.roots = links, settled(connected(links))


def _least_linked(limit: float) -> int:
    """Smallest set that can be alike enough to a different one: n of n + 1 shingles."""
    n = 1
    while n < limit * (n + 1) - 1e-9:
        n += 1
    return n


def _sizes_fit(a: str, b: str, limit: float) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * round(limit * 100)


def _differing(a: Column, b: Column) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def near_classes(docs: DataFrame, limit: float = 0.8, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, fp, root, component_id`` (smallest id reachable over links).

    Two rows are linked if their sets of shingles share at least ``limit`` (in hundredths) of their union.  Texts
    of fewer words than a shingle have one, texts without a word (or null) none and are linked with nothing:
    their component is their own id.  Rows with a null id take part; a component whose ids are all null has a
    null id.  Repeated rows and equal sets are one class from the start.  Other columns are not read.  An empty
    table gives an empty table.  ``fp`` names the set, ``root`` the component (null for empty sets).
    """
    if limit < 0.8:
        raise ValueError("the trees are made for a similarity of 0.8 or more")
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text"))
    hashed = written(map_arrow(
        rows, _set_batches(shingle), "id bigint, n bigint, fp bigint, keys array<bigint>, deeps array<bigint>, sketch array<bigint>"), "forest-sets")
    alone = hashed.where(f"n >= {_least_linked(limit)}").groupBy("fp").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", "keys", "deeps", "sketch")])
    forest = _Forest(rows, written(alone, "forest-distinct"), limit, shingle)
    forest.meet(forest.neighbours(FIRST))
    forest.meet_families()
    classes = hashed.where("n > 0").groupBy("fp").agg(F.min("id").alias("rep"))
    rooted = settled(classes.join(forest.roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    names = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "root", "component_id")
    # empty sets share a fingerprint but no class
    found = hashed.select("id", "n", F.when(F.col("n") > 0, F.col("fp")).alias("fp")).join(named, "fp", "left")
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "fp", "root",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
