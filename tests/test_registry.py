"""Every registered query against its SQL on the smallest tables."""

import os

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tillwright.plans.catalog import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare.compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    report = entry(spark)
    assert len(report.columns) == 25 and report.count() > 0
