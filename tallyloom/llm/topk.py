"""Exact top-k by inner product in three phases with a uniform threshold.

A vector's score is the sum of its scores on ``parts`` blocks of dimensions.
1. Every chunk of candidates gathers, per query and block, the k best local
   scores.  The k-th best whole score among those rows is a safe cutoff.
2. The cutoff is sent to all chunks.  A row can only reach it if some block
   reaches cutoff / parts; rows that do are collected, unless even their known
   blocks plus that bound for every other block stay below the cutoff.
3. What is left gets its missing blocks scored exactly, and the k best stay.
Queries are packed into blocks of bounded size.  Every chunk meets a copy of every
block; the copies are dealt with the chunks and pass by in sorted order, never
joined, so that no plan takes them for small and sends them to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.llm.arrow import batch_of, map_arrow
from tallyloom.session import settled

QUERY_BLOCK, CHUNK = 512, 4096  # expected rows of a block of queries and of a chunk of candidates
_NONE = -(1 << 62)  # cutoff while fewer than k rows are known
_FOUND = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``row_id, vec_id, comps``: floor(256 x) of every component, with a number of its own for every row.

    Rows with a null id, a null vector or a null, infinite or NaN component are
    left out.  Rows that repeat an id, or repeat as a whole, all count.  Numbers
    are written once, so every later job sees the same ones.
    """
    x = F.col(vector)
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    comps = F.transform(x, lambda v: F.floor(F.lit(256.0) * v.cast("double")).cast("bigint"))
    kept = vectors.where(F.col(key).isNotNull() & x.isNotNull() & sound)
    return settled(kept.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(key).cast("bigint").alias("vec_id"), comps.alias("comps")))


def _block(blocks: int, seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), "row_id"), F.lit(blocks)).cast("int")


def _meetings(queries: DataFrame, vectors: DataFrame, chunks: int, blocks: int, *extra: str) -> DataFrame:
    """``dim, chunk_id, asks, rows``: of every chunk first its vectors, a row each, then all blocks of queries of their dimension."""
    dim, row = F.size("comps").alias("dim"), ("row_id", "vec_id", "comps")
    candidates = vectors.select(
        dim, _block(chunks, 1).alias("chunk_id"), F.lit(False).alias("asks"),
        F.array(F.struct(*row, *(F.lit(_NONE).alias(x) for x in extra))).alias("rows"))
    # as many tasks as blocks: each block is copied once for every chunk
    packed = queries.select(dim, _block(blocks, 2).alias("block"), F.struct(*row, *extra).alias("row")).repartition(
        blocks, "dim", "block").groupBy("dim", "block").agg(F.collect_list("row").alias("rows"))
    copies = packed.select("dim", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk_id"), F.lit(True).alias("asks"), "rows")
    return candidates.union(copies).repartition(chunks, "dim", "chunk_id").sortWithinPartitions("dim", "chunk_id", "asks")


def _unpacked(rows: pa.StructArray, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and vectors."""
    numbers, ids = (rows.field(x).to_numpy(zero_copy_only=False) for x in ("row_id", "vec_id"))
    return numbers, ids, rows.field("comps").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def _block_scores(queries: np.ndarray, chunk: np.ndarray, parts: int) -> list[np.ndarray]:
    """Score of every query and row on each block of dimensions, exact.

    Float products are exact while sums stay below 2^53; beyond it whole numbers are used.
    """
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(chunk).max(initial=0)) * max(1, chunk.shape[1])
    kind = np.float64 if bound < 2**53 else np.int64
    edges = [chunk.shape[1] * i // parts for i in range(parts + 1)]
    return [queries[:, a:b].astype(kind) @ chunk[:, a:b].astype(kind).T for a, b in zip(edges, edges[1:])]


def _best(k: int, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        keep = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((ids[keep], -score[keep]))[:k]]


def _each_pair(batches: Iterator[pa.RecordBatch], of_pair) -> Iterator[pa.RecordBatch]:
    """Results of every block of queries with the chunk that came before it: a task holds one chunk at a time."""
    key, parts = None, []
    for batch in batches:
        keys = np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in ("dim", "chunk_id", "asks")])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            dim, chunk_id, asks = keys[:, start].tolist()
            if key != (dim, chunk_id):
                key, parts = (dim, chunk_id), []
            if not asks:  # copied: else a part would keep its whole batch in memory
                parts.append([x.copy() for x in _unpacked(batch.column("rows").slice(start, stop - start).flatten(), dim)])
                continue
            if not parts:
                continue
            if len(parts) > 1:
                parts = [[np.concatenate(x) for x in zip(*parts)]]
            others, v_ids, v = parts[0]
            for at in range(start, stop):
                rows = batch.column("rows")[at].values
                own, q_ids, q = _unpacked(rows, dim)
                found = list(of_pair(own, q, rows, others, v, v_ids))
                if found:
                    sizes = [len(places) for _, places, _ in found]
                    which = np.repeat([i for i, _, _ in found], sizes)
                    yield batch_of(
                        query_row=pa.array(own[which]), query_id=pa.array(q_ids[which]),
                        vec_id=pa.array(v_ids[np.concatenate([places for _, places, _ in found])]),
                        score=pa.array(np.concatenate([x for _, _, x in found]).astype(np.int64)))


def _local_lists(k: int, parts: int):
    def of_pair(own, q, _, others, v, v_ids):
        scores = _block_scores(q, v, parts)
        whole = sum(scores)
        for i, row in enumerate(own):
            top = np.unique(np.concatenate([_top_places(k + 1, s[i]) for s in scores]))
            top = top[others[top] != row]
            yield i, top, whole[i, top]

    return lambda batches: _each_pair(batches, of_pair)


def _top_places(k: int, score: np.ndarray) -> np.ndarray:
    return np.arange(len(score)) if len(score) <= k else np.argpartition(score, len(score) - k)[len(score) - k :]


def _sufficient(k: int, parts: int):
    def of_pair(own, q, q_rows, others, v, v_ids):
        scores = _block_scores(q, v, parts)
        cutoffs = q_rows.field("cutoff").to_numpy(zero_copy_only=False)
        for i, row in enumerate(own):
            cut = cutoffs[i]
            other = others != row
            if cut == _NONE:
                left = np.flatnonzero(other)
            else:
                sent = np.array([s[i] * parts >= cut for s in scores])  # blocks that reach cutoff / parts
                known = sum(np.where(m, s[i], 0) for m, s in zip(sent, scores))
                missing = parts - sent.sum(0)
                # a block not sent is below cutoff / parts
                left = np.flatnonzero(other & (missing < parts) & (known * parts + missing * float(cut) >= cut * float(parts) - 1))
            exact = sum(s[i, left] for s in scores)
            reach = exact >= cut
            left, exact = left[reach], exact[reach]
            top = _best(k, exact, v_ids[left])
            if len(top):
                yield i, left[top], exact[top]

    return lambda batches: _each_pair(batches, of_pair)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, parts: int = 4) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows of ``vectors`` except the query's own row.

    Both sides are rows of one table ``row_id, vec_id, comps`` as ``quantised``
    makes it; every query row has its own list, also where ids repeat.  Only
    vectors of the query's dimension are compared.  Ties go to the smaller id; a
    query with fewer than ``k`` candidates gets them all.  Empty tables give no row.
    """
    chunks = max(1, -(-vectors.count() // CHUNK))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    local = map_arrow(_meetings(queries, vectors, chunks, blocks), _local_lists(k, parts), _FOUND)
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    cut = local.withColumn("_p", place).where(F.col("_p") == k).select(F.col("query_row").alias("row_id"), F.col("score").alias("cutoff"))
    marked = settled(
        queries.join(cut, "row_id", "left").select("row_id", "vec_id", "comps", F.coalesce("cutoff", F.lit(_NONE)).alias("cutoff")))
    resolved = map_arrow(_meetings(marked, vectors, chunks, blocks, "cutoff"), _sufficient(k, parts), _FOUND)
    return (
        resolved.withColumn("rank", place.cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
