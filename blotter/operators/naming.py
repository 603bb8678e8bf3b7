"""Column renaming with checks (``withColumnRenamed`` silently ignores typos)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip leading/trailing blanks from every column name (``'AREA '`` -> ``'AREA'``)."""
    mapping = {c: c.strip() for c in df.columns if c != c.strip()}
    stripped = [mapping.get(c, c) for c in df.columns]
    if len(set(stripped)) != len(stripped):
        raise ValueError(f"trimming column names creates duplicates: {stripped}")
    return df.withColumnsRenamed(mapping) if mapping else df


def rename_strict(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; a source name that does not exist raises."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}; have {df.columns}")
    return df.withColumnsRenamed(dict(mapping))
