"""Great-circle distance as a native column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions._col import ColumnOrName, as_col

# Fixed value: mean Earth radius in kilometres used for all distances.
EARTH_RADIUS_KM = 6371.0


def haversine_km(
    lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName
) -> Column:
    """Haversine distance in km between two points given in degrees.

    NULL in, NULL out.  The haversine term is clamped to [0, 1] so rounding
    near antipodal points cannot produce the square root of a negative number.
    """
    return km_of_term(haversine_term(lat1, lon1, lat2, lon2))


def haversine_term(
    lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName
) -> Column:
    """The term whose root is the sine of half the angle between two points."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    dphi = p2 - p1
    dlmb = F.radians(as_col(lon2)) - F.radians(as_col(lon1))
    return F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)


def km_of_term(a: Column) -> Column:
    """The distance in km of a haversine term; NULL in, NULL out."""
    # CASE, not least/greatest: those skip NULLs and would turn a missing
    # coordinate into distance 0.
    a = F.when(a < 0.0, F.lit(0.0)).when(a > 1.0, F.lit(1.0)).otherwise(a)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))
