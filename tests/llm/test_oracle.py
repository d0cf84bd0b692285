"""Queries that SQL can express give the same rows as their SQL."""

import pytest

from quillmine.llm import queries
from tests.oracle import connect, mismatch


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, sf, name):
    assert mismatch(spark, connect(sf), queries.QUERIES[name], queries.ORACLE_SQL[name], sf) is None


def test_every_operator_has_its_query():
    assert [sum(name.startswith(f"op{n}_") for name in queries.QUERIES) for n in range(1, 11)] == [1] * 10
