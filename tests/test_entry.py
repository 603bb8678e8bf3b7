"""Driver contract of __spark_entry__.py."""

import __spark_entry__ as entry
from blotter.plans import roster


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "incident_total", "ranking"]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "int", "bigint", "int"]
    assert df.count() > 0


def test_every_reference_query_has_oracle_sql():
    missing = sorted(set(roster.QUERIES) - set(entry.oracle_sql()))
    assert missing == [], f"keys without oracle SQL: {missing}"
    assert set(entry.oracle_sql()) <= set(entry.queries())
