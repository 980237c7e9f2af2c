from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_tables import ROWS, SCHEMA, wide


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(wide(ROWS), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(autouse=True)
def few_partitions(conf):
    """The tables here are tiny, and the plans long."""
    conf(shuffle__partitions="2")
