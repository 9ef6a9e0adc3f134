"""Every registered query against its SQL, on the smallest provided tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the provided tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= queries().keys() and oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    cube = entry(spark)
    assert len(cube.columns) == 22 and cube.count() > 0
