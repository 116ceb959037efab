"""Every registered query against its SQL on the small test tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from snapmart.suite import oracles, queries

QUERIES, SQL = queries.registry(), oracles.oracles()

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF), db, SQL[name]) == ""


def test_entry(spark):
    assert len(entry.entry(spark).collect()) == 5
