"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from msgloom.queries import load_all
from msgloom.queries.registry import ORACLES as SQL
from msgloom.queries.registry import QUERIES
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).columns == ["status", "events", "total_value"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    found = differences(spark, con, name, QUERIES[name], SQL[name], SF_DIR)
    assert found in (None, "no rows"), found
