"""Registered queries against their check SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest
from oracle import compare, duck

from tickerloom.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF) == ""


def test_one_query_an_operator():
    numbers = [name.split("_")[0] for name in queries.QUERIES]
    assert sorted(numbers) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])
