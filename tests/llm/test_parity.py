"""Queries of the subpackage: SQL where there is some, and the driver's names."""

import re

import pytest

from tallyloom.llm import QUERIES, SQL
from tests.parity import compare, duck


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), duck(folder), SQL[name]) == []


def test_every_number_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 11))


def test_the_rest_does_not_import_it():
    import pathlib

    root = pathlib.Path(__file__).parents[2] / "tallyloom"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text(), path
