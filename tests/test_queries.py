"""Every driver query against its SQL at the smallest scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from compare import difference, duck

SF = "/root/testdata/sf0.001"
# The text operators have tests of their own.
NAMES = [name for name in contract.queries() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_its_sql():
    assert set(NAMES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, connection, name):
    found = contract.queries()[name](spark, SF).toPandas()
    assert len(found) > 0
    assert difference(found, connection.execute(contract.oracle_sql()[name]).df()) is None


def test_entry(spark):
    best = contract.entry(spark)
    assert best.columns == ["w1", "w2", "w3", "p", "rank"]
    assert best.count() > 10_000
