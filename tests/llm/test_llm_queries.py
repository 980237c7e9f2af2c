"""Every query with SQL against it, and that all are there."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from compare import difference, duck
from trigramma.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


def test_there_is_a_query_for_each_operator():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries()}
    assert numbers == set(range(1, 14))
    assert set(oracle.oracle_sql()) <= set(queries.queries())
    assert {"pipeline", *queries.queries()} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_as_sql(spark, name):
    found = queries.queries()[name](spark, FOLDER).toPandas()
    assert len(found) > 0
    assert difference(found, duck(FOLDER).execute(oracle.oracle_sql()[name]).df()) is None
