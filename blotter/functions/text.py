"""Parsing of external text: dates, currency strings, delimited fields.

Spark 4 runs with ANSI mode on, where a bad cast or date throws and fails the
whole job.  Incident exports contain junk, so every parse here is a ``try_*``
form that yields NULL instead (the pre-ANSI behaviour the original scripts
relied on).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType

from blotter.functions._col import ColumnOrName, as_col

# Fixed value: the incident export's date-time layout (12-hour clock).
INCIDENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def parse_ts(c: ColumnOrName, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """String -> timestamp; malformed text gives NULL."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt))


def parse_currency(c: ColumnOrName, dtype: DataType = IntegerType()) -> Column:
    """``'$12,345'`` -> 12345.  Every ``$`` and ``,`` is removed; anything
    that is still not a number (``'n/a'``) becomes NULL."""
    return F.regexp_replace(as_col(c), r"[$,]", "").try_cast(dtype)


def as_text(c: ColumnOrName) -> Column:
    """Render a code column as text for prefix tests (``101`` -> ``'101'``)."""
    return as_col(c).cast("string")


def split_field(line: ColumnOrName, sep: str, index: int) -> Column:
    """Field ``index`` of a naively split line; NULL when the line is short.

    Plain ``[i]`` indexing throws out of range under ANSI; ``get`` does not.
    """
    return F.get(F.split(as_col(line), re.escape(sep), -1), index)
