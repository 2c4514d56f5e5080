"""Every text query that has SQL against it, on the smallest tables."""

import os

import compare
import pytest

from __spark_entry__ import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
NAMES = [n for n in queries() if n == "pipeline" or n.startswith("op")]


def test_all_operators_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in NAMES


@pytest.mark.parametrize("name", [n for n in NAMES if n in oracle_sql()])
def test_query(spark, name):
    assert compare.compare(queries()[name](spark, SF_DIR), compare.connect(SF_DIR), oracle_sql()[name]) is None
