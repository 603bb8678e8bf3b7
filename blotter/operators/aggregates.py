"""Counting, decoding and duplicate checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.codes import decode


def count_by(df: DataFrame, keys: Sequence[str] | str, name: str = "n") -> DataFrame:
    """Rows per key (partial count per task, then a shuffle of the partials)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def decode_codes(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str] | None = None,
    table: DataFrame | None = None,
    code_col: str = "code",
    label_col: str = "label",
) -> DataFrame:
    """Replace codes in ``column`` by labels; unknown codes and NULL pass through.

    Give a small ``mapping`` (literal map in the expression) or a ``table``
    of ``(code, label)`` rows, which is joined - broadcast or shuffled as
    AQE measures it - so a code list of any size works.  A code listed twice
    has its smallest label; rows never multiply.
    """
    if (mapping is None) == (table is None):
        raise ValueError("give exactly one of mapping or table")
    if mapping is not None:
        return df.withColumn(column, decode(column, mapping))
    lookup = table.groupBy(F.col(code_col).alias("_code")).agg(F.min(label_col).alias("_label"))
    joined = df.join(lookup, F.col(column) == F.col("_code"), "left")
    return joined.withColumn(column, F.coalesce("_label", column)).drop("_code", "_label")


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Keys that occur more than once, with their count - a distributed check
    (not a driver loop) for lookups that would silently fan out a join."""
    return count_by(df, keys, "n").filter(F.col("n") > 1)
