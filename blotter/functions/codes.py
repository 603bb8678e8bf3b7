"""Code -> label decoding."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions._col import ColumnOrName, as_col

# Victim descent codes of the incident export and their labels.
DESCENT_CODES = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
}


def decode(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Map codes to labels; unknown codes and NULL pass through unchanged.

    The mapping is a literal map inside the expression, so it is shipped with
    the task code: fine for tens or hundreds of codes.  For a code table that
    grows with the data use ``operators.decode_codes(..., table=...)``, which
    joins instead.
    """
    col = as_col(c)
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(lookup, col), col)
