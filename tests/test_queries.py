"""Every registered query next to its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    rows, problem = compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 100
