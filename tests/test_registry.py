"""Every registered query beside its SQL twin on the smallest test data."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck, spark_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    got = spark_rows(entry.queries()[name](spark, SF))
    twin = entry.oracle_sql().get(name)
    if twin is None:
        assert got[1]
    else:
        assert difference(got, duck(SF, twin)) is None


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "restaurant_id"
