"""Row filters.  Each is written so Catalyst can push it into the scan when the
column is stored: typed literals, plain comparisons, range predicates."""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Context, Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    TimestampNTZType,
    TimestampType,
)

from blotter.functions.text import INCIDENT_TS_FORMAT, as_text, parse_ts


_WHOLE = re.compile(r"\s*[+-]?[0-9]+\s*")


def _typed_literal(value, dtype: DataType):
    """A code given as text in the column's type, so the predicate is
    ``EqualTo(col, 101)`` and not a per-row cast of the column.  Catalyst
    folds the cast; text that is no value of the type becomes NULL, which
    equals nothing.

    A decimal column holds a code only if it has all its digits: ``10.555`` is
    no value of ``decimal(10,2)`` and must not be rounded to one.  Likewise a
    whole-number column has no fractions, whatever the session's ANSI setting."""
    text = str(value)
    none = F.lit(None).cast(dtype)
    if isinstance(dtype, DecimalType):
        try:
            number = Decimal(text.strip())
        except InvalidOperation:
            return none
        if "_" in text or not number.is_finite():
            return none
        sign, digits, exponent = number.normalize(Context(prec=max(1, len(number.as_tuple().digits)))).as_tuple()
        if digits != (0,) and (-exponent > dtype.scale or len(digits) + exponent > dtype.precision - dtype.scale):
            return none
        return F.lit(format(number, "f")).try_cast(dtype)
    if isinstance(dtype, IntegralType) and not _WHOLE.fullmatch(text):
        return none
    return F.lit(text).try_cast(dtype)


def code_filter(df: DataFrame, column: str, code) -> DataFrame:
    """Keep rows whose code equals ``code`` (``'101'`` matches int 101)."""
    return df.filter(F.col(column) == _typed_literal(code, df.schema[column].dataType))


def prefix_filter(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Keep rows whose code, as text, starts with ``prefix``.

    Note ``'1'`` matches 1, 11, 102, ... not only three-digit codes.
    """
    return df.filter(as_text(column).startswith(prefix))


def year_filter(df: DataFrame, column: str, year: int, fmt: str | None = None) -> DataFrame:
    """Keep rows of calendar ``year``.

    On a stored timestamp/date column the test is a half-open range on the
    raw column, which Parquet can push down and prune row groups with.  On a
    text column (``fmt`` given, or string type) the text is parsed first;
    unparseable dates are dropped.
    """
    dtype = df.schema[column].dataType
    if fmt is None and isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        lo = F.lit(f"{year:04d}-01-01 00:00:00").cast(dtype)
        hi = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast(dtype)
        return df.filter((F.col(column) >= lo) & (F.col(column) < hi))
    ts = parse_ts(column, fmt or INCIDENT_TS_FORMAT)
    return df.filter(F.year(ts) == F.lit(year))


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is present (pushed as IsNotNull)."""
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(cond)


def drop_null_island(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Drop rows whose latitude *or* longitude is 0 (unknown location) or NULL."""
    return df.filter((F.col(lat) != 0) & (F.col(lon) != 0))


def drop_malformed(df: DataFrame, column: str, dtype: DataType | str) -> DataFrame:
    """Keep rows whose ``column`` parses as ``dtype``; nothing throws."""
    return df.filter(F.col(column).try_cast(dtype).isNotNull())
