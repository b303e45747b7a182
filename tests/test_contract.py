"""Every registered query against its SQL statement on the smallest driver tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from contract.compare import compare, connect
from contract.queries import QUERIES

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns[0] == "subreddit"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, DIR, name) in ("", "no rows")
