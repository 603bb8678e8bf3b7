"""Queries that SQL expresses, against DuckDB on whole tables."""

import pytest

from blotter.llm import registry
from tests.conftest import SF001, SF01
from tools.oracle_check import compare, duck


@pytest.mark.parametrize("sf", [SF001, SF01])
@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_matches_oracle(spark, key, sf):
    result = compare(spark, duck(sf), key, registry.QUERIES[key], registry.ORACLE[key], sf)
    assert result["status"] in ("exact", "approx"), result


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 14))
