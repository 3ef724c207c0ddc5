"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences, oracle_frame
from workload.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = queries()[name](spark, SF)
    assert differences(got.toPandas(), oracle_frame(SF, oracle_sql()[name])) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["src_host", "n_pages", "n_links", "n_targets"]
    assert rows.count() > 0
