"""Arrow tasks: functions over record batches, importable on every worker."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(df: DataFrame) -> None:
    """Let workers import this package also when the driver was started elsewhere.

    On a cluster ship the package with ``--py-files``; the folder added here then matches nothing.
    """
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    importable(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            handed_back()

    return df.mapInArrow(run, schema)


def handed_back() -> None:
    """Give freed memory back to the machine: a worker outlives its task, and so would what the task used."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def raw(value: pa.Scalar) -> bytes:
    """Bytes of a binary scalar, nothing for null."""
    return value.as_py() or b""


_HELD: dict[str, Any] = {}


def held(name: str, load: Callable[[], Any]) -> Any:
    """The model a worker works with; a worker holds one at a time, whatever operators it served before."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = load()
    return _HELD[name]
