"""Every query that SQL can express gives the same rows as its SQL."""

import os

import pytest

from quillmine.plans import catalogue

from .oracle import connect, mismatch


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, sf, name):
    if name in catalogue.ORACLE_SQL:
        assert mismatch(spark, con, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name], sf) is None
    else:
        assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_sql_belongs_to_queries():
    assert set(catalogue.ORACLE_SQL) <= set(catalogue.QUERIES)
    assert os.path.exists(os.path.join(os.path.dirname(__file__), "oracle.py"))
