"""Time-of-day helpers for HHMM-packed times (``2015`` = 20:15, ``15`` = 00:15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions._col import ColumnOrName, as_col

# Part-of-day buckets, inclusive hour bounds.  Any other hour
# (21-23, 0-4, out of range) is Night.
PART_OF_DAY_BOUNDS = [
    ("Morning", 5, 11),
    ("Afternoon", 12, 16),
    ("Evening", 17, 20),
]
NIGHT = "Night"


def hour_of_hhmm(c: ColumnOrName, pad: str = "lpad") -> Column:
    """Hour of an HHMM value given as int or text; NULL when unparseable.

    ``pad='lpad'`` left-pads to 4 and truncates longer values (SQL ``lpad``);
    ``pad='zfill'`` pads but never truncates, and puts the zeros after a
    leading sign.  Both then read the first two characters as the hour.
    """
    text = as_col(c).cast("string")
    if pad == "lpad":
        padded = F.lpad(text, 4, "0")
    elif pad == "zfill":
        # zeros go after a leading sign, as Python's str.zfill does
        width = F.greatest(F.lit(4), F.length(text))
        signed = text.startswith("-") | text.startswith("+")
        rest = text.substr(F.lit(2), F.length(text))
        padded = F.when(
            signed, F.concat(text.substr(1, 1), F.lpad(rest, width - 1, "0"))
        ).otherwise(F.lpad(text, width, "0"))
    else:
        raise ValueError(f"pad must be 'lpad' or 'zfill', got {pad!r}")
    return F.substring(padded, 1, 2).try_cast("int")


def part_of_day(hour: ColumnOrName, invalid: str = "other") -> Column:
    """Bucket an hour into Morning / Afternoon / Evening / Night.

    ``invalid='other'``: a NULL hour falls through to Night (CASE semantics).
    ``invalid='null'``: a NULL hour stays NULL so the caller can drop it.
    The hour is read by every bucket test; pass a column (computed in an
    earlier projection) rather than a long expression.
    """
    h = as_col(hour)
    expr = None
    for label, lo, hi in PART_OF_DAY_BOUNDS:
        cond = h.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if invalid == "other":
        return expr.otherwise(NIGHT)
    if invalid == "null":
        return F.when(h.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(NIGHT))
    raise ValueError(f"invalid must be 'other' or 'null', got {invalid!r}")
