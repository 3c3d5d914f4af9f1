"""Vector best-fit packing of pieces into sequences.

Every sequence has three capacities: tokens, pieces and attention cost (the sum
of squared lengths).  Pieces are dealt to groups of bounded size by a hash; in a
group they are taken from the largest down, and each goes to the open sequence
that fits under every constraint and is best by the chosen rule:

* ``norm``: the smallest weighted norm of what would be left of the capacities,
* ``dot``: the largest weighted product of the piece's needs with what is left now.

A new sequence is opened only if none fits.  A group wastes at most a part of its
last few sequences, which its size makes a small share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.arrow import importable
from tallyloom.llm.tokens import token_pieces
from tallyloom.session import settled

GROUP_ROWS = 8192


def best_fit(lengths: np.ndarray, capacity: int, max_pieces: int, max_cost: float,
             weights: tuple[float, float, float] = (1.0, 0.02, 0.02), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece.  A piece that breaks a capacity alone is an error."""
    limits = np.array([capacity, max_pieces, max_cost], float)
    needs = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], axis=1) / limits
    if len(needs) and needs.max() > 1 + 1e-12:
        raise ValueError("a piece exceeds a capacity")
    scale = np.array(weights)
    order = np.lexsort((np.arange(len(lengths)), -(needs @ scale)))
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.zeros((len(lengths), 3))  # of open sequences, in units of the capacities
    names, filled = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    count = made = 0
    smallest = np.minimum.accumulate(lengths[order][::-1])[::-1] / capacity if len(lengths) else lengths
    for rank, i in enumerate(order.tolist()):
        need = needs[i]
        room = left[:count]
        fits = np.flatnonzero((room >= need - 1e-12).all(axis=1))
        if len(fits):
            after = room[fits] - need
            score = -((after * after) @ scale) if rule == "norm" else (room[fits] * need) @ scale
            at = int(fits[np.argmax(score)])
        else:
            at = count
            left[at], names[at], filled[at] = 1.0, made, 0
            count, made = count + 1, made + 1
        bins[i], offsets[i] = names[at], filled[at]
        filled[at] += lengths[i]
        left[at] -= need
        if left[at, 0] < smallest[rank] - 1e-12:  # nothing that follows fits: close it
            count -= 1
            left[at], names[at], filled[at] = left[count], names[count], filled[count]
    return bins, offsets


def packed(pieces: DataFrame, capacity: int = 4096, max_pieces: int | None = None, max_cost: float | None = None,
           weights: tuple[float, float, float] = (1.0, 0.02, 0.02), rule: str = "norm", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length``.

    Without ``max_pieces`` or ``max_cost`` these capacities are those that the
    token capacity implies, and never bind.  Rows keep all their columns; an
    empty table gives no rows.
    """
    max_pieces, max_cost = max_pieces or capacity, max_cost or float(capacity) ** 2
    held = settled(pieces)
    groups = max(1, -(-held.count() // group_rows))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema) + ", sequence_id bigint, offset bigint"
    # numbered after the checkpoint, so numbers are the same whenever a task runs again, and equal rows spread
    dealt = held.withColumn("_g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        bins, offsets = best_fit(rows.column("length").to_numpy(), capacity, max_pieces, max_cost, weights, rule)
        ids = pa.array(bins + (key[0].as_py() << 32))
        return rows.drop_columns(["_g"]).append_column("sequence_id", ids).append_column("offset", pa.array(offsets))

    importable(dealt)
    return dealt.groupBy("_g").applyInArrow(pack, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, **options) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens in as few sequences as the packing finds."""
    return packed(token_pieces(docs, path, capacity), capacity, **options)
