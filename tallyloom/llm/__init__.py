"""Operators of a training-data pipeline and their registered queries."""

from tallyloom.llm import queries_mixing, queries_pairs, queries_text, queries_trees, queries_turns  # noqa: F401  (registers)
from tallyloom.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
