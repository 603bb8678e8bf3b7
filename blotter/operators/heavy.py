"""Shuffle joins whose frequent keys, and only those, are split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.joins import _SALTABLE

#: Keys that are split at most, and counters of the sketch that finds them.
MOST_KEYS, COUNTERS = 64, 4096
#: A key is split into parts of about this share of a task's mean rows.
PART = 1 / 16


def heavy_keys(df: DataFrame, keys: Sequence[str], tasks: int) -> dict[int, int]:
    """Hash of each frequent key of ``df`` -> number of parts to split it into.

    Frequent is what holds over a quarter of the mean rows of one of ``tasks``
    tasks.  The counts come from a frequent-items sketch (Misra-Gries), which is
    built in each task and merged: one job, ``MOST_KEYS`` rows to the driver.
    NULL keys are not counted, :func:`join_heavy` spreads them anyway.
    """
    hashed = df.dropna(subset=list(keys)).select(F.xxhash64(*keys).alias("k"))
    found = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {MOST_KEYS}, {COUNTERS})").alias("top")).first()
    if not found["n"]:
        return {}
    mean = found["n"] / tasks
    return {t["item"]: max(2, round(t["count"] / (mean * PART))) for t in found["top"] or [] if t["count"] > mean / 4}


def _parts(key_hash: Column, heavy: dict[int, int]) -> Column:
    if not heavy:
        return F.lit(1)
    literal = F.create_map(*[F.lit(x) for item in heavy.items() for x in item])
    return F.coalesce(F.element_at(literal, key_hash), F.lit(1))


def join_heavy(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner",
    by: Sequence[str] | None = None, tasks: int | None = None, heavy: dict[int, int] | None = None,
) -> DataFrame:
    """Equi-join in which each frequent key of ``left`` is dealt over several
    tasks and only the matching rows of ``right`` are replicated; all other keys
    are joined once, in the same join.

    For sessions without adaptive skew handling, or where it does not apply.
    Rows of a frequent key are dealt by a hash of the columns ``by`` (default:
    the whole row), so a retried task deals them alike.  Rows of ``left`` with a
    NULL key, kept by an outer or anti join, are spread over all ``tasks`` (default:
    the session's shuffle partitions).  ``heavy`` takes the result of an earlier
    :func:`heavy_keys`; otherwise one job finds them.  Exact for joins that
    preserve only the left side.
    """
    if how.lower() not in _SALTABLE:
        raise ValueError(f"the right side is replicated; not valid for {how!r} joins")
    keys = [on] if isinstance(on, str) else list(on)
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left, keys, tasks) if heavy is None else heavy
    parts = _parts(F.xxhash64(*keys), heavy)
    none = F.lit(False)
    for key in keys:
        none = none | F.col(key).isNull()
    row = F.xxhash64(*[F.col(f"`{c}`") for c in by or left.columns])
    dealt = left.withColumn("_part", F.pmod(row, F.when(none, F.lit(tasks)).otherwise(parts)).cast("int"))
    copied = right.withColumn("_part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    return dealt.join(copied, [*keys, "_part"], how).drop("_part")
