"""Every registered query against its SQL twin on the smallest test tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from haulmart.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    from compare import duck as connect

    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == [
        "Region", "ProductType", "SaleYear", "SaleMonth", "Transactions", "TotalRevenue",
    ]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, key):
    from compare import compare

    text, equal = compare(spark, duck, SF_DIR, key, queries()[key], oracle_sql().get(key))
    assert equal, text
