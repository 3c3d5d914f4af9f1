"""Token counts and ids of whole texts by compiled transducers."""

from __future__ import annotations

import pickle
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.arrow import held, map_arrow
from tallyloom.llm.transducer import PIECE, Tokenizer, pieces

#: Rows and characters of the texts on which the driver compiles the first states; they change no count.
COMPILE_ROWS, COMPILE_CHARS = 2000, 20_000


class Compiled:
    """A tokenizer compiled on some texts, sent to the workers once; each worker goes on compiling on its own."""

    def __init__(self, docs: DataFrame, path: str, text: str = "text"):
        tokenizer = Tokenizer(path)
        share = max(1, docs.count() // COMPILE_ROWS)
        some = docs.where(F.pmod(F.xxhash64(text), F.lit(share)) == 0).select(F.substring(text, 1, COMPILE_CHARS)).limit(COMPILE_ROWS)
        counted(tokenizer, [r[0] or "" for r in some.collect()])
        self.name = uuid.uuid4().hex
        self.sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(tokenizer, 5))

    def get(self) -> Tokenizer:
        return held(self.name, lambda: pickle.loads(self.sent.value))


def _parts(tokenizer: Tokenizer, texts: list[str]):
    """``owner, part, special id or -1``: texts cut at special strings, long ones at white space too."""
    special = re.compile("|".join(map(re.escape, tokenizer.special))) if tokenizer.special else None
    for owner, text in enumerate(texts):
        at = 0
        for hit in special.finditer(text) if special else ():
            yield from ((owner, p, -1) for p in pieces(text[at : hit.start()]))
            yield owner, "", tokenizer.special[hit.group()]
            at = hit.end()
        yield from ((owner, p, -1) for p in pieces(text[at:] if at else text))


def _runs(tokenizer: Tokenizer, texts: list[str], keep: bool):
    """As ``_parts`` with count and ids, run in lots of about ``PIECE`` characters."""
    lot, size = [], 0

    def done():
        counts, ids = tokenizer.run([tokenizer.normal(p) for _, p, _ in lot], keep)
        for i, (owner, _, special) in enumerate(lot):
            if special >= 0:
                yield owner, 1, np.array([special], np.int32)
            else:
                yield owner, int(counts[i]), ids[i] if keep else None

    for part in _parts(tokenizer, texts):
        lot.append(part)
        size += len(part[1])
        if size >= PIECE:
            yield from done()
            lot, size = [], 0
    if lot:
        yield from done()


def counted(tokenizer: Tokenizer, texts: list[str]) -> np.ndarray:
    """Tokens of each text, as the library gives them (special strings are one token)."""
    out = np.zeros(len(texts), np.int64)
    for owner, count, _ in _runs(tokenizer, texts, False):
        out[owner] += count
    return out


def encoded(tokenizer: Tokenizer, texts: list[str]) -> Iterator[np.ndarray]:
    """Token ids of each text."""
    held, at = [], 0
    for owner, _, ids in _runs(tokenizer, texts, True):
        while at < owner:
            yield np.concatenate(held) if held else np.zeros(0, np.int32)
            held, at = [], at + 1
        held.append(ids)
    while at < len(texts):
        yield np.concatenate(held) if held else np.zeros(0, np.int32)
        held, at = [], at + 1


def texts_of(column: pa.Array) -> list[str]:
    return [(v.as_py() or b"").decode("utf-8", "replace") for v in column]


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row; a null text counts as empty (0 and 0).

    Whole texts of any length; rows are independent, so repeats, null ids and
    further columns change nothing.  No shuffle.
    """
    compiled = Compiled(docs, path, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = compiled.get()
        for batch in batches:
            counts = counted(tokenizer, texts_of(batch.column(1)))
            sizes = np.array([len(v.as_py() or b"") for v in batch.column(1)], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def token_pieces(docs: DataFrame, path: str, capacity: int = 4096, end: int = 1, with_ids: bool = False,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): each text's ids and ``end``, cut every ``capacity`` tokens.

    A null or empty text is the end token alone.  ``ids_crc32`` is over the
    little-endian 32-bit ids of the piece.
    """
    compiled = Compiled(docs, path, text)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = compiled.get()
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoded(tokenizer, texts_of(batch.column(1)))):
                ids = np.append(ids, end).astype("<u4")
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc, piece, at, len(part), zlib.crc32(part.tobytes()), part if with_ids else None))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            if with_ids:
                arrays.append(pa.array([p.astype(np.int64) for p in columns[5]], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
                     + ", ids array<bigint>" * with_ids)
