"""Nearest lookup point within a distance."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.geo import EARTH_RADIUS_KM, haversine_term, km_of_term
from blotter.operators.joins import broadcast_fits

# Lookup points of a cell in one row, at most.
LIST_POINTS = 32
# A lookup point is copied to so many cells; most bytes of copies broadcast.
COPIES, MAX_COPIED_BYTES = 9, 16 * 1024 * 1024


def _band(lat: Column, step: float) -> Column:
    return F.floor((lat + 90.0) / step)


def _cells(band: Column, step: float, half_chord: float) -> Column:
    """Cells of longitude around the globe in a band of latitude: as many as
    leave each cell wider than two points within the tolerance can be apart."""
    top, bottom = (band + 2) * step - 90.0, (band - 1) * step - 90.0
    narrowest = F.cos(F.radians(F.least(F.lit(90.0), F.greatest(F.abs(top), F.abs(bottom)))))
    width = F.degrees(2 * F.asin(F.least(F.lit(1.0), F.lit(half_chord) / F.greatest(narrowest, F.lit(1e-12))))) * (1 + 1e-6)
    return F.greatest(F.lit(1), F.floor(360.0 / width))


def _cell(lon: Column, cells: Column) -> Column:
    return F.least(cells - 1, F.floor(F.pmod(lon, F.lit(360.0)) / (360.0 / cells)))


def geo_near(
    facts: DataFrame, geo: DataFrame, tolerance_km: float, on: Sequence[str] = ("lat", "lon"),
    cols: Sequence[str] = ("zip",), distance: str = "distance_km",
) -> DataFrame:
    """``facts`` with ``cols`` of the nearest ``geo`` point within
    ``tolerance_km`` (great circle), and the ``distance`` to it; NULL where
    there is none.

    Unlike rounding coordinates this misses no pair across a rounding edge.
    The globe is cut into bands of latitude as high as the tolerance and each
    band into cells at least as wide, so points within the tolerance lie in
    neighbouring cells (also across the date line and at the poles).  Lookup
    points are copied to the nine cells around them, distinct fact points stay
    in their own.  The copies in a cell are put into lists of ``LIST_POINTS``
    (a cell with more has several rows), so a fact point meets a row per list,
    not per lookup point: an equi-join on the cell, the nearest of each list by
    exact distance, and the nearest of the lists by a partial aggregate.  Many
    facts at one point count once in it.

    Of points equally near the smallest (lat, lon, cols) is taken.  Facts
    without coordinates match nothing.  Candidates per fact are the lookup
    points within nine cells: choose a tolerance that holds few.
    """
    lat, lon = on
    step = math.degrees(tolerance_km / EARTH_RADIUS_KM) * (1 + 1e-6)
    half_chord = math.sin(min(math.pi / 2, tolerance_km / (2 * EARTH_RADIUS_KM)))
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    values = [f"_v{i}" for i in range(len(cols))]
    points = facts.filter(known).select(F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")).distinct()
    own = points.withColumn("_band", _band(F.col("_lat"), step)).withColumn(
        "_cell", _cell(F.col("_lon"), _cells(F.col("_band"), step, half_chord)))
    lookup = geo.filter(known).select(F.col(lat).cast("double").alias("_glat"), F.col(lon).cast("double").alias("_glon"),
                                      *[F.col(c).alias(v) for c, v in zip(cols, values)]).dropna(subset=["_glat", "_glon"])
    around = F.sequence(F.lit(-1), F.lit(1))
    banded = lookup.withColumn("_away", F.explode(around)).withColumn(
        "_band", _band(F.col("_glat"), step) + F.col("_away")).withColumn("_n", _cells(F.col("_band"), step, half_chord))
    near_cells = F.array_distinct(F.transform(around, lambda k: F.pmod(_cell(F.col("_glon"), F.col("_n")) + k, F.col("_n"))))
    copied = banded.withColumn("_cell", F.explode(near_cells)).select(
        F.struct("_band", "_cell").alias("_square"), F.struct("_glat", "_glon", *values).alias("_place"))
    # numbered by the square as one column: the join by band and cell deals the
    # lists out anew, so that a crowded cell is split there like any skewed key
    ordered = Window.partitionBy("_square").orderBy("_place._glat")
    listed = copied.select(
        "_square", F.row_number().over(ordered).alias("_nth"),
        F.collect_list("_place").over(ordered.rowsBetween(0, LIST_POINTS - 1)).alias("_places"),
    ).filter(F.col("_nth") % LIST_POINTS == 1).select("_square._band", "_square._cell", "_places")
    # the planner's estimate leaves the copies out
    if not broadcast_fits(lookup, MAX_COPIED_BYTES // COPIES):
        listed = listed.hint("merge")
    # two steps: inside a lambda Spark works out a repeated term each time anew
    terms = F.transform("_places", lambda p: F.struct(
        haversine_term("_lat", "_lon", p["_glat"], p["_glon"]).alias("_term"), p.alias("_place")))
    best = F.array_min(F.transform(terms, lambda t: F.struct(
        km_of_term(t["_term"]).alias("_km"), *[t["_place"][c].alias(c) for c in ("_glat", "_glon", *values)])))
    met = own.join(listed, ["_band", "_cell"]).select("_lat", "_lon", best.alias("_best"))
    # tested after the aggregate: a test before it would have each distance computed twice
    nearest = met.groupBy("_lat", "_lon").agg(F.min("_best").alias("_best")).filter(F.col("_best._km") <= tolerance_km)
    found = nearest.select("_lat", "_lon", *[F.col(f"_best.{v}").alias(c) for c, v in zip(cols, values)],
                           F.col("_best._km").alias(distance))
    joined = facts.join(found, (facts[lat].cast("double") == found["_lat"]) & (facts[lon].cast("double") == found["_lon"]), "left")
    return joined.select(*[facts[c] for c in facts.columns], *[found[c] for c in (*cols, distance)])
