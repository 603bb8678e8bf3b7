"""Q4: mean distance from firearm incidents to their area's police station.

Incidents whose weapon code starts with ``1`` are joined to stations on the
area code, the haversine distance is computed per pair as a native
expression, and mean distance and incident count are reported per division.

Stations are a dimension: one (or a few) per area.  With no hint the planner
broadcasts them when their size estimate is small and AQE does so at runtime
after measuring; the incident side is never shuffled in that case, and only
per-task partial (sum, count) pairs per division cross the network.
Otherwise both sides are shuffled by area and AQE splits a hot one.

The two repartition/broadcast variants of the original differ in what they
do with several stations for one area: the repartition form keeps every
pair, the broadcast form keeps one station per area.  Here that is the
``dedupe`` parameter (smallest station key wins), not a different algorithm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.distance import distance_by_group
from blotter.operators.filters import prefix_filter
from blotter.operators.naming import rename_strict
from blotter.plans.standins import (
    LINE_FACTS_SQL,
    STATIONS_SQL,
    lat_of,
    lat_sql,
    line_incidents,
    lon_of,
    lon_sql,
    stations,
    table,
)


def firearm_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rename_strict(line_incidents(spark, sf_dir), {"AREA ": "AREA"})
    return prefix_filter(facts, "weapon_cd", "1")


def station_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_strict(
        stations(spark, sf_dir), {"PREC": "AREA", "X": "STATION_LAT", "Y": "STATION_LON"}
    )


def q_distance_by_group(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return distance_by_group(
        firearm_incidents(spark, sf_dir), station_points(spark, sf_dir), "AREA", "s_name", **options
    )


def _paired_area(df: DataFrame, key: str) -> DataFrame:
    """Two stations share each division: area = key div 2."""
    return df.withColumn("division", F.expr(f"`{key}` div 2"))


def q_distance_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffle (sort-merge) join; every station of a division is paired."""
    facts = _paired_area(firearm_incidents(spark, sf_dir), "AREA").drop("AREA")
    st = _paired_area(station_points(spark, sf_dir), "AREA").drop("AREA")
    return distance_by_group(facts, st, "division", "division", strategy="merge")


def q_distance_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broadcast join after keeping one station per division: the smallest
    station key; some stations have none, and some divisions have only those."""
    facts = _paired_area(firearm_incidents(spark, sf_dir), "AREA").drop("AREA")
    st = _paired_area(station_points(spark, sf_dir), "AREA")
    unknown = F.col("AREA") % 10 == 4
    unknown |= (F.col("AREA") % 20).isin(8, 9)
    key = F.when(unknown, F.lit(None)).otherwise(F.col("AREA")).alias("station_key")
    st = st.select("division", key, "STATION_LAT", "STATION_LON")
    return distance_by_group(
        facts, st, "division", "division", strategy="broadcast", dedupe="station_key"
    )


def q_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers to their nation's reference point, mean distance per nation."""
    cust = table(spark, sf_dir, "customer").select(
        "c_nationkey", lat_of("c_custkey").alias("LAT"), lon_of("c_custkey").alias("LON")
    )
    ref = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"),
        lat_of("n_nationkey").alias("STATION_LAT"),
        lon_of("n_nationkey").alias("STATION_LON"),
    )
    return distance_by_group(cust, ref, "c_nationkey", "c_nationkey", count_name="n")


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)"
    )
    a = f"(CASE WHEN ({a}) < 0.0 THEN 0.0::DOUBLE WHEN ({a}) > 1.0 THEN 1.0::DOUBLE ELSE ({a}) END)"
    return f"(12742.0::DOUBLE * atan2(sqrt({a}), sqrt(1 - {a})))"


_DIST = haversine_sql("f.lat", "f.lon", "s.slat", "s.slon")
_PAIRS_WHERE = "f.lat <> 0 AND f.lon <> 0 AND s.slat <> 0 AND s.slon <> 0"

QUERIES = {
    "distance_by_group": q_distance_by_group,
    "distance_repartition": q_distance_repartition,
    "distance_broadcast": q_distance_broadcast,
    "haversine": q_haversine,
}

ORACLE = {
    "distance_by_group": f"""WITH {LINE_FACTS_SQL},
{STATIONS_SQL}
SELECT s.s_name, round(AVG({_DIST}), 6) AS average_distance, COUNT(*) AS incidents_total
FROM facts f JOIN stations s ON f.area = s.area
WHERE {_PAIRS_WHERE} GROUP BY 1""",
    "distance_repartition": f"""WITH {LINE_FACTS_SQL},
{STATIONS_SQL}
SELECT f.area // 2 AS division, round(AVG({_DIST}), 6) AS average_distance,
       COUNT(*) AS incidents_total
FROM facts f JOIN stations s ON f.area // 2 = s.area // 2
WHERE {_PAIRS_WHERE} GROUP BY 1""",
    "distance_broadcast": f"""WITH {LINE_FACTS_SQL},
{STATIONS_SQL},
keyed AS (SELECT area // 2 AS division, slat, slon,
                 CASE WHEN area % 10 = 4 OR area % 20 IN (8, 9) THEN NULL ELSE area END AS station_key
          FROM stations WHERE slat <> 0 AND slon <> 0),
one AS (SELECT division, slat, slon FROM (
          SELECT *, row_number() OVER (PARTITION BY division ORDER BY station_key NULLS LAST, slat, slon) AS place
          FROM keyed) WHERE place = 1)
SELECT f.area // 2 AS division, round(AVG({haversine_sql("f.lat", "f.lon", "s.slat", "s.slon")}), 6)
       AS average_distance, COUNT(*) AS incidents_total
FROM facts f JOIN one s ON f.area // 2 = s.division
WHERE f.lat <> 0 AND f.lon <> 0 GROUP BY 1""",
    "haversine": f"""WITH c AS (SELECT c_nationkey, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon
           FROM customer),
r AS (SELECT n_nationkey, {lat_sql('n_nationkey')} AS slat, {lon_sql('n_nationkey')} AS slon
      FROM nation)
SELECT c.c_nationkey, round(AVG({haversine_sql("c.lat", "c.lon", "r.slat", "r.slon")}), 6) AS average_distance,
       COUNT(*) AS n
FROM c JOIN r ON c.c_nationkey = r.n_nationkey
WHERE c.lat <> 0 AND c.lon <> 0 AND r.slat <> 0 AND r.slon <> 0 GROUP BY 1""",
}
