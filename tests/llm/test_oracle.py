"""Pipeline queries against their SQL on the smallest tables."""

from __future__ import annotations

import pytest

from msgloom.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert differences(spark, connect(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR) is None
