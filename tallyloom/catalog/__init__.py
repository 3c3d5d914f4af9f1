"""Named queries over the standard tables, most with an equivalent SQL text."""

from tallyloom.catalog import dates, fits, measuring, samples, sequences, tables, vectors, words  # noqa: F401  (registers)
from tallyloom.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
