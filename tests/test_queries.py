"""Every query that SQL can express, against DuckDB on the smallest tables."""

import os

import pytest
from oracle import difference

from tidewater.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, name):
    assert difference(spark, catalog.queries()[name], catalog.oracle_sql()[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
