"""Every registered query against its SQL on the driver's tables."""

from __future__ import annotations

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    if name in SQL:
        assert compare(got, duck.execute(SQL[name]).fetchdf()) is None
    else:
        assert len(got) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
