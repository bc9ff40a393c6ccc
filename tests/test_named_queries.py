"""Every named query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from panelspark.registered import QUERIES

from .oracle import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = queries()[name](spark, FOLDER)
    if name in SQL:
        assert differences(result, con, SQL[name]) is None
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry(spark).count() == 149
