"""Every roster key against its DuckDB oracle on sf0.01 (the driver's gate)."""

import pytest

from blotter.plans import roster
from tests.conftest import SF01
from tools.oracle_check import compare, duck

KEYS = sorted(roster.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    result = compare(spark, con, key, roster.QUERIES[key], roster.ORACLE[key], SF01)
    assert result["status"] in ("exact", "approx"), result
