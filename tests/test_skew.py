"""A key holding a third of all rows: results stay whole and the hot key is split."""

import pytest
from pyspark.sql import functions as F

from blotter.operators import distance_by_group
from blotter.plans.station_distance import firearm_incidents, station_points
from tests.conftest import SF01, final_plan

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_facts(spark):
    """Firearm incidents where every third row moves to area 1.

    The test file is a single row group (one map task); AQE splits a hot
    partition along map tasks, so the facts are spread over several input
    partitions first, as a large input would be."""
    facts = firearm_incidents(spark, SF01).repartition(8, "LAT", "LON")
    facts = facts.withColumn("_h", F.xxhash64("LAT", "LON", "weapon_cd", "AREA"))
    return facts.withColumn(
        "AREA", F.when(F.pmod("_h", F.lit(3)) == 0, F.lit(1).cast("bigint")).otherwise(F.col("AREA"))
    ).drop("_h")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_hot_key_is_split_by_aqe(skew_session):
    spark = skew_session
    facts, st = hot_facts(spark), station_points(spark, SF01)
    out = distance_by_group(facts, st, "AREA", "s_name", strategy="merge")
    plan = final_plan(out)
    assert "SortMergeJoin" in plan and "skew=true" in plan


def test_hot_key_is_split_where_the_group_is_the_join_key(skew_session):
    spark = skew_session
    facts, st = hot_facts(spark), station_points(spark, SF01)
    out = distance_by_group(facts, st, "AREA", "AREA", strategy="merge")
    plan = final_plan(out)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    whole = facts.filter("LAT != 0 AND LON != 0").groupBy("AREA").count()
    assert {r["AREA"]: r.incidents_total for r in out.collect()} == {r["AREA"]: r["count"] for r in whole.collect()}


def test_hot_key_results_whole_under_every_form(skew_session):
    spark = skew_session
    facts, st = hot_facts(spark), station_points(spark, SF01)
    hot_rows = facts.filter("AREA = 1 AND LAT != 0 AND LON != 0").count()
    base = rows(distance_by_group(facts, st, "AREA", "s_name", strategy="merge"))
    assert dict((r[0], r[2]) for r in base)["Supplier#000000001"] == hot_rows
    assert rows(distance_by_group(facts, st, "AREA", "s_name", strategy="merge", salt=8)) == base
    assert rows(distance_by_group(facts, st, "AREA", "s_name", strategy="broadcast")) == base
