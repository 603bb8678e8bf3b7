"""Column expressions over whole texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes outside space and tab..carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: Column) -> Column:
    """The text, a NULL as the empty string."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``docs`` has it (in any case)."""
    taken, found = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
