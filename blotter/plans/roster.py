"""Registry of every query key -> Spark plan, and key -> oracle SQL."""

from __future__ import annotations

from blotter.plans import (
    cleaning,
    extended,
    formats,
    income_descent,
    part_of_day,
    station_distance,
    streams,
    top_months,
)

QUERIES = {}
ORACLE = {}
for _module in (top_months, part_of_day, income_descent, station_distance, cleaning, formats, extended, streams):
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
