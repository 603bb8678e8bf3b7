"""Mean distance between facts and their reference location, per group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.geo import haversine_km
from blotter.operators.filters import drop_null_island
from blotter.operators.joins import join_with_strategy


def distance_by_group(
    facts: DataFrame,
    stations: DataFrame,
    on: str | Sequence[str],
    group: str | Sequence[str],
    fact_point: tuple[str, str] = ("LAT", "LON"),
    station_point: tuple[str, str] = ("STATION_LAT", "STATION_LON"),
    strategy: str | None = None,
    dedupe: str | None = None,
    digits: int | None = 6,
    count_name: str = "incidents_total",
    salt: int | None = None,
    salt_by: Sequence[str] | None = None,
    distance: Callable[[Column, Column, Column, Column], Column] = haversine_km,
) -> DataFrame:
    """``group, average_distance, <count_name>`` for facts joined to stations.

    Rows at the null island (either coordinate 0 or NULL) are dropped on both
    sides.  The inner join drops facts without a station and NULL keys.  The
    distance is a native expression evaluated in the join's codegen stage and
    immediately reduced by a partial aggregate, so only per-task partial sums
    per group are shuffled - a group holding a third of all rows costs no
    more shuffle than any other.  ``strategy=None`` gives no hint: stations
    within Spark's byte threshold are broadcast, otherwise AQE measures both
    sides and splits hot keys.  Where ``group`` equals ``on`` the aggregate
    could reuse the join's partitioning, which keeps AQE from splitting; the
    session therefore sets ``forceOptimizeSkewedJoin``, and sessions without
    it can ``salt`` (by the unique columns ``salt_by``).
    ``dedupe`` (an ordering column) keeps one station per key; otherwise
    every matching station counts.  ``distance``
    maps (lat1, lon1, lat2, lon2) columns to km; keep it a native expression.
    """
    groups = [group] if isinstance(group, str) else list(group)
    keys = [on] if isinstance(on, str) else list(on)
    flat, flon = fact_point
    slat, slon = station_point
    facts = drop_null_island(facts, flat, flon)
    stations = drop_null_island(stations, slat, slon)
    joined = join_with_strategy(facts, stations, keys, "inner", strategy, dedupe=dedupe, salt=salt, salt_by=salt_by)
    # Distance in a projection, not inside the aggregate: the projection's
    # generated code computes the repeated haversine term once per row.
    dist = distance(F.col(flat), F.col(flon), F.col(slat), F.col(slon))
    measured = joined.select(*[F.col(g) for g in groups], dist.alias("_distance"))
    out = measured.groupBy(*groups).agg(
        F.avg("_distance").alias("average_distance"), F.count(F.lit(1)).alias(count_name)
    )
    if digits is not None:
        out = out.withColumn("average_distance", F.round("average_distance", digits))
    return out.orderBy(F.col(count_name).desc(), *[F.col(g).asc_nulls_first() for g in groups])
