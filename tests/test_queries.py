"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from daygrain.plans.oracle import ORACLE as OWN_ORACLE
from daygrain.plans.queries import QUERIES as OWN_QUERIES

QUERIES = {name: driver.queries()[name] for name in OWN_QUERIES}
ORACLE = {name: driver.oracle_sql()[name] for name in OWN_ORACLE}


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, data_dir, name):
    assert differences(QUERIES[name](spark, data_dir), con, ORACLE[name]) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:2] == ["city", "date"]
    assert df.count() > 0
