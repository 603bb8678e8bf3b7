"""Column -> Column helpers.  All are native Spark expressions (no Python UDFs),
so they stay inside whole-stage codegen and never fail on malformed text."""

from blotter.functions.codes import DESCENT_CODES, decode
from blotter.functions.geo import EARTH_RADIUS_KM, haversine_km
from blotter.functions.text import as_text, parse_currency, parse_ts, split_field
from blotter.functions.timeparts import PART_OF_DAY_BOUNDS, hour_of_hhmm, part_of_day

__all__ = [
    "DESCENT_CODES",
    "EARTH_RADIUS_KM",
    "PART_OF_DAY_BOUNDS",
    "as_text",
    "decode",
    "haversine_km",
    "hour_of_hhmm",
    "parse_currency",
    "parse_ts",
    "part_of_day",
    "split_field",
]
