"""Sparse rows packed into blocks, so that one pass over the data serves many linear models.

A block is one row of four binary columns: where each document ends, its label, and
the positions and values of its words.  Positions below 65,536 take two bytes, and
where every document has one value for all its words that value is kept once.  Blocks
are built once; a pass then reads them as arrays, without a join, an explode or a
shuffle of features, and only sums per slice of the dictionary are exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.losses import RowLoss
from tallyloom.session import importable

BLOCK = 1 << 18  # values of a block
SLICE = 1 << 16  # dictionary positions whose sums travel together
_SCHEMA = "pass int, ends binary, label binary, pos binary, value binary"


@dataclass(frozen=True)
class Side:
    """What a model learns: ``target`` against the other labels (the label itself if None), without one label."""

    model: RowLoss
    target: float | None = None
    without: float | None = None

    def sums(self, block: "Block", weights: np.ndarray) -> tuple[float, np.ndarray, int]:
        """Loss, gradient and documents of a block."""
        y = block.label if self.target is None else np.where(block.label == self.target, 1.0, self.model.negative)
        loss, slope = self.model.arrays(y, block.margins(weights))
        docs = len(y)
        if self.without is not None:
            keep = block.label != self.without
            loss, slope, docs = loss[keep], np.where(keep, slope, 0.0), int(keep.sum())
        return float(loss.sum()), block.spread(slope, len(weights)), docs


class Block:
    """Documents of one packed row."""

    def __init__(self, ends: bytes, label: bytes, pos: bytes, value: bytes):
        self.ends, self.label = np.frombuffer(ends, np.int64), np.frombuffer(label, np.float64)
        words = int(self.ends[-1])
        self.pos = np.frombuffer(pos, np.uint16 if len(pos) == 2 * words else np.int32).astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        values = np.frombuffer(value, np.float64)
        # one value a document, or one a word
        self.scale, self.values = (values, None) if len(values) == len(self.ends) else (None, values)

    @property
    def value(self) -> np.ndarray:
        return np.repeat(self.scale, self.ends - self.starts) if self.values is None else self.values

    def margins(self, weights: np.ndarray) -> np.ndarray:
        at = weights[self.pos]
        if self.values is None:
            return np.add.reduceat(at, self.starts) * self.scale
        return np.add.reduceat(self.values * at, self.starts)

    def spread(self, slope: np.ndarray, width: int) -> np.ndarray:
        """Sum of ``slope * value`` per position."""
        sizes = self.ends - self.starts
        if self.values is None:
            return np.bincount(self.pos, np.repeat(slope * self.scale, sizes), width)
        return np.bincount(self.pos, np.repeat(slope, sizes) * self.values, width)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``pass, doc, label, pos, value`` sorted by pass and document to blocks of whole documents of one pass."""
    held: list[pa.RecordBatch] = []

    def block(rows: pa.Table) -> pa.RecordBatch:
        doc = rows["doc"].combine_chunks()
        new = np.flatnonzero(pc.not_equal(doc[1:], doc[:-1]).to_numpy(zero_copy_only=False)) + 1
        starts = np.concatenate([[0], new]).astype(np.int64)
        ends = np.append(starts[1:], len(doc))
        pick = lambda name, kind: rows[name].to_numpy().astype(kind)
        pos, value = pick("pos", np.int32), pick("value", np.float64)
        scale = value[starts]
        if (value == np.repeat(scale, ends - starts)).all():
            value = scale
        if pos.min() >= 0 and pos.max() < 1 << 16:
            pos = pos.astype(np.uint16)
        parts = ends.astype(np.int64), pick("label", np.float64)[starts], pos, value
        return pa.RecordBatch.from_arrays(
            [pa.array([rows["pass"][0].as_py()], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
            ["pass", "ends", "label", "pos", "value"])

    def cut(last: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        number, doc = (rows[c].combine_chunks() for c in ("pass", "doc"))
        differs = pc.not_equal(number[1:], number[:-1]).to_numpy(zero_copy_only=False)
        passes = np.flatnonzero(differs) + 1
        docs = np.flatnonzero(differs | pc.not_equal(doc[1:], doc[:-1]).to_numpy(zero_copy_only=False)) + 1
        at = 0
        while at < rows.num_rows:
            end = passes[np.searchsorted(passes, at, "right")] if len(passes) and passes[-1] > at else rows.num_rows
            if end - at > BLOCK:  # the last document that still fits, or the first if none does
                inside = docs[(docs > at) & (docs < end)]
                if len(inside):
                    end = inside[max(0, np.searchsorted(inside, at + BLOCK, "right") - 1)]
            if end == rows.num_rows and not last:
                held.extend(rows.slice(at).to_batches())
                return
            yield block(rows.slice(at, end - at))
            at = int(end)

    waiting = 0
    for batch in batches:
        held.append(batch)
        waiting += batch.num_rows
        if waiting >= 2 * BLOCK:
            yield from cut(False)
            waiting = sum(b.num_rows for b in held)
    if held and sum(b.num_rows for b in held):
        yield from cut(True)


def packed(features: DataFrame, key: str = "doc_id", label: str = "label", batch: str | None = None) -> DataFrame:
    """Blocks of features ``key, label, pos, value``; with ``batch`` each block lies in one pass (else -1).

    A row without a key belongs to the document without one.  Little data make few blocks, for a pass costs
    more tasks than work then.
    """
    doc = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("")).alias("doc")
    number = (F.lit(-1) if batch is None else F.col(batch)).cast("int").alias("pass")
    rows = features.select(number, doc, F.col(label).cast("double").alias("label"), F.col("pos").cast("int"), F.col("value").cast("double"))
    count, cores = features.count(), features.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, count // BLOCK), count // (16 * BLOCK))
    importable(features)
    return rows.repartition(tasks, "pass", "doc").sortWithinPartitions("pass", "doc").mapInArrow(_pack, _SCHEMA)


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for row in zip(*(batch.column(i) for i in range(1, 5))):
        yield Block(*(c.as_py() for c in row))


def _partial_sums(sides: Sequence[Side], weights: Sequence[np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(weights[0])
        heads, sums = np.zeros((len(sides), 2)), np.zeros((len(sides), width))
        for batch in batches:
            for block in _blocks(batch):
                for i, (side, w) in enumerate(zip(sides, weights)):
                    loss, gradient, docs = side.sums(block, w)
                    heads[i] += loss, docs
                    sums[i] += gradient
        if heads[:, 1].any():
            parts = [heads, *(sums[:, at : at + SLICE] for at in range(0, width, SLICE))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([np.ascontiguousarray(p).tobytes() for p in parts], pa.binary())], ["slice", "sums"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, sums in zip(*(c.to_pylist() for c in batch.columns)):
            part = np.frombuffer(sums, np.float64)
            totals[number] = totals[number] + part if number in totals else part
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], ["slice", "sums"])


def pass_plan(blocks: DataFrame, sides: Sequence[Side], weights: Sequence[np.ndarray]) -> DataFrame:
    """One pass for all sides: ``slice, sums`` (slice 0: loss and documents), after a single exchange of sums."""
    slices = 1 + -(-len(weights[0]) // SLICE)
    tasks = min(slices, blocks.sparkSession.sparkContext.defaultParallelism)
    partial = blocks.mapInArrow(_partial_sums(list(sides), list(weights)), "slice int, sums binary")
    return partial.repartition(tasks, "slice").mapInArrow(_added, "slice int, sums binary")


def pass_over(blocks: DataFrame, sides: Sequence[Side], weights: Sequence[np.ndarray]) -> list[tuple[float, np.ndarray, int]]:
    """Loss, gradient and documents of each side; what comes back is as long as the weights that went out."""
    parts = {r["slice"]: np.frombuffer(r["sums"], np.float64).reshape(len(sides), -1) for r in pass_plan(blocks, sides, weights).collect()}
    if not parts:
        return [(0.0, np.zeros(len(w)), 0) for w in weights]
    gradients = np.concatenate([parts[i] for i in sorted(parts) if i], axis=1)
    return [(float(loss), gradient, int(docs)) for (loss, docs), gradient in zip(parts[0], gradients)]


class Batches:
    """Packed blocks of drawn batches, fetched in lots of at most ``lot`` bytes; a batch beyond that is summed where it lies."""

    def __init__(self, blocks: DataFrame, lot: int = 64 << 20):
        self.blocks, self.lot = blocks, lot
        sizes = blocks.groupBy("pass").agg(F.sum(F.octet_length("value") + F.octet_length("pos")).alias("bytes")).collect()
        self.sizes = {r["pass"]: r["bytes"] for r in sizes}
        self.held: dict[int, list[Block]] = {}

    def sums(self, number: int, side: Side, weights: np.ndarray) -> tuple[float, np.ndarray, int] | None:
        """Loss, gradient and documents of one batch; None if it is empty."""
        if number not in self.sizes:
            return None
        if self.sizes[number] > self.lot:
            return pass_over(self.blocks.where(F.col("pass") == number), [side], [weights])[0]
        if number not in self.held:
            self._fetch(number)
        parts = [side.sums(block, weights) for block in self.held[number]]
        return sum(p[0] for p in parts), sum(p[1] for p in parts), sum(p[2] for p in parts)

    def _fetch(self, number: int) -> None:
        """The batches from here on that fit into a lot replace those held."""
        total, last = 0, number
        for n in sorted(s for s in self.sizes if s >= number):
            total += self.sizes[n]
            if total > self.lot:
                break
            last = n
        self.held = {n: [] for n in self.sizes if number <= n <= last}
        for r in self.blocks.where(F.col("pass").between(number, last)).collect():
            self.held[r["pass"]].append(Block(r["ends"], r["label"], r["pos"], r["value"]))
