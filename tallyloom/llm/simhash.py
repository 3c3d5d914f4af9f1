"""Near-duplicate classes by SimHash with deletion-variant signatures.

Four differing bits spread over three segments leave one segment with at most
one of them.  Every fingerprint is therefore indexed under each of its segments
with each single bit left out (64 keys); two segments differ in at most one bit
exactly when they share such a key.  Equal keys meet by one shuffle, candidates
are verified on the whole fingerprint, and only a spanning set of the links
leaves a task, so no group emits all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from tallyloom.llm.arrow import batch_of, map_arrow
from tallyloom.llm.components import connected
from tallyloom.session import settled

SHINGLE, SEED = 4, 42
_BLOCK = 1 << 16  # shingles whose bits are unpacked at once
_RUN = 512  # longer runs of one key are cut again


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of whole text: a bit is set if it is set in over half the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((simhash(t.as_py() or b"") for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed long) of every row; a null text counts as empty."""
    return map_arrow(
        docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text")),
        _fingerprint_batches, "doc_id bigint, fp bigint")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the fewest segments of which one has at most one differing bit."""
    count = distance // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def variant_keys(fp: str, distance: int):
    """The fingerprint's segments with one bit left out each, as 64 longs that name segment and bit too."""
    if not 2 <= distance < 64:
        raise ValueError("distance must be 2 or more")
    keys = []
    for low, width in _segments(distance):
        segment = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
        keys += [segment.bitwiseAND(F.lit(~(1 << i))).bitwiseOR(F.lit((low + i) << 57)) for i in range(width)]
    return keys


def _shift_pairs(keys: np.ndarray, fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of equal key within the distance; ``keys`` is sorted."""
    at = np.arange(len(keys))
    step = 1
    while True:
        at = at[: np.searchsorted(at, len(keys) - step)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            return
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= distance]
        if len(near):
            yield fps[near], fps[near + step]
        step += 1


def _near_pairs(keys: np.ndarray, fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As above; runs beyond ``_RUN`` are first cut by equal pieces of the fingerprint.

    Among ``distance + 1`` pieces two near fingerprints share one, so nothing is lost.
    """
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    long = np.repeat(sizes > _RUN, sizes)
    yield from _shift_pairs(keys[~long], fps[~long], distance)
    for start, size in zip(starts[sizes > _RUN], sizes[sizes > _RUN]):
        run = fps[start : start + size]
        edges = [64 * i // (distance + 1) for i in range(distance + 2)]
        for low, high in zip(edges, edges[1:]):
            piece = (run >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
            order = np.argsort(piece, kind="stable")
            yield from _shift_pairs(piece[order], run[order], distance)


def _spanning(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Each linked fingerprint with the smallest one it reaches through these pairs."""
    left, right = (np.concatenate(x) for x in zip(*pairs))
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    tied = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[tied], nodes[root[tied]]


def _link_batches(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(keys, fps):
            pairs = list(_near_pairs(keys, fps, distance)) if len(keys) else []
            if pairs:
                a, b = _spanning(pairs)
                yield batch_of(a=pa.array(a.view(np.int64)), b=pa.array(b.view(np.int64)))

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            if len(keys) < 1 << 18 or keys[0] == keys[-1]:
                continue
            whole = np.searchsorted(keys, keys[-1])  # the last key may go on in the next batch
            yield from links(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
        yield from links(keys, fps)

    return run


def near_links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints ``fp`` within ``distance`` bits, not all their pairs."""
    posted = prints.select("fp").distinct().select(
        F.explode(F.array(*variant_keys("fp", distance))).alias("key"), "fp")
    # at large sizes 20-bit keys fill up; the shuffle is by key, and runs are cut in the task
    return map_arrow(posted.repartition("key").sortWithinPartitions("key", "fp"), _link_batches(distance), "a bigint, b bigint")


def near_classes(docs: DataFrame, distance: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fp, root, component_id`` (smallest doc_id reachable over links).

    Rows with a null id take part; the id of a class is null only if all its ids
    are.  Repeated rows, ties and empty texts share a fingerprint and so a class.
    Other columns are not read.  An empty table gives an empty table.
    """
    prints = settled(fingerprints(docs, key, text))
    return classes_of(prints, near_links(prints, distance))


def classes_of(prints: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id, fp, root, component_id`` of all rows ``doc_id, fp`` by the links ``a, b`` of fingerprints; ``root`` names the class."""
    roots = connected(links)
    per_print = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    rooted = settled(
        per_print.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "fp", "root", "component_id")


def near_deduplicated(docs: DataFrame, distance: int = 4) -> DataFrame:
    """The row with the smallest id of every class.

    Rows are judged one by one, also where they share an id: of several rows with a
    class's smallest id the least by text and then by the other columns stays.  Rows
    without an id cannot be named as members of a class and stay.
    """
    classes = settled(near_classes(docs, distance))
    gone = classes.where("doc_id <> component_id").select("doc_id").distinct()
    repeated = settled(classes.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    left = docs.join(gone.unionByName(repeated), "doc_id", "left_anti")
    rows = docs.join(repeated, "doc_id", "left_semi").select(F.struct("text", *[c for c in docs.columns if c != "text"]).alias("_row"))
    printed = map_arrow(
        rows.select("_row", F.col("_row.text").cast("binary").alias("_text")), _print_rows,
        f"_row {rows.schema['_row'].dataType.simpleString()}, _fp bigint")
    firsts = classes.where("doc_id = component_id").select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).distinct()
    classed = printed.join(firsts, (F.col("_row.doc_id") == F.col("_id")) & (printed["_fp"] == firsts["_fp"]))
    roots = classes.select("doc_id", "fp", "root").distinct()
    once = (
        classed.select("_row", "_id", printed["_fp"])
        .join(roots, (F.col("_id") == roots["doc_id"]) & (F.col("_fp") == roots["fp"]))
        .groupBy("root").agg(F.min("_row").alias("_row")).select("_row.*")
    )
    return left.select(*docs.columns).unionByName(once.select(*docs.columns))


def _print_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((simhash(t.as_py() or b"") for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["_row", "_fp"])
