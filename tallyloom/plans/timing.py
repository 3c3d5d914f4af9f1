"""Wall time of phases as a table."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


class Phases:
    """``with phases("train"): ...`` around *actions*; a lazy transformation takes no time."""

    def __init__(self) -> None:
        self._began = time.perf_counter()
        self.seconds: list[tuple[str, float]] = []

    @contextmanager
    def __call__(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.seconds.append((name, time.perf_counter() - began))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [*self.seconds, ("total", time.perf_counter() - self._began)]
        return spark.createDataFrame([(n, round(s, 2)) for n, s in rows], "phase string, seconds double")
