"""Joins and running totals over time whose work splits inside a key.

All three cut time into blocks of a fixed width.  A window then spans one block
of one key, and what passes from block to block is a second, small pass over one
row per key and block: a key that holds most rows is spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def block_of(df: DataFrame, column: str, width: float) -> Column:
    """Number of the block of ``width`` (seconds, on times) a value lies in."""
    kind = df.schema[column].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return F.floor(F.unix_micros(F.col(column).cast("timestamp")) / F.lit(int(width * 1_000_000)))
    return F.floor(F.col(column) / F.lit(width))


def _not_null(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def asof_join(
    left: DataFrame, right: DataFrame, on: str, by: Sequence[str], cols: Sequence[str], width: float,
) -> DataFrame:
    """``left`` with ``cols`` of the last ``right`` row of the same key ``by`` at
    or before the row's ``on``, and that row's time as ``asof_<on>``; NULL where
    there is none.

    Both sides are sorted together in blocks of ``width`` (seconds, if ``on`` is a
    time); the last row of each block is carried to the blocks after it.  Of
    right rows of one key and time the one with the greatest ``cols`` counts.
    NULL keys or times match nothing; their left rows are kept.
    """
    by, at = list(by), f"asof_{on}"
    value = F.struct(F.col(on).alias("at"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    rights = right.filter(_not_null([*by, on])).select(
        *by, F.col(on).alias("_on"), block_of(right, on, width).alias("_block"), value.alias("_value"))
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    lefts = left.select(*by, F.col(on).alias("_on"), block_of(left, on, width).alias("_block"), row.alias("_row"))
    both = lefts.withColumn("_side", F.lit(1)).unionByName(rights.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    # right rows first at equal times, the greatest of them last
    inside = Window.partitionBy(*by, "_block").orderBy("_on", "_side", "_value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("_seen", F.last("_value", ignorenulls=True).over(inside)).filter("_side = 1")
    # one row per key and block: the last value of all blocks before
    ends = both.groupBy(*by, "_block").agg(F.max("_value").alias("_last"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).filter(
        F.col("_carried").isNotNull()).drop("_last")
    names = [*by, "_block"]
    carried = carried.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)], "_carried")
    same = F.lit(True)
    for i, c in enumerate(names):
        same = same & (F.col(c) == F.col(f"_c{i}"))
    met = seen.join(carried, same, "left").withColumn("_found", F.coalesce("_seen", "_carried"))
    return met.select("_row.*", F.col("_found.at").alias(at), *[F.col(f"_found.v{i}").alias(c) for i, c in enumerate(cols)])


def interval_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], width: float,
) -> DataFrame:
    """Pairs of rows of the same key ``by`` whose closed intervals (first and
    last value) overlap; a point is an interval whose ends are one column.

    Each interval is copied to the blocks of ``width`` (seconds, on times) that
    it touches, the sides meet by an equi-join on key and block, and a pair is
    kept in the first block that both touch, so it comes once.  ``width`` near the
    usual length of an interval copies little and compares little.  Column
    names of the two sides must differ but for ``by``.  NULL keys or ends, and
    intervals that end before they begin, match nothing.
    """
    by = list(by)

    def blocked(df: DataFrame, span: tuple[str, str], first: str) -> DataFrame:
        begin, end = span
        usable = df.filter(_not_null([*by, begin, end]) & (F.col(begin) <= F.col(end)))
        low, high = block_of(df, begin, width), block_of(df, end, width)
        return usable.withColumn(first, low).withColumn("_block", F.explode(F.sequence(F.col(first), high)))

    met = blocked(left, left_span, "_first_left").join(blocked(right, right_span, "_first_right"), [*by, "_block"])
    overlap = (F.col(left_span[0]) <= F.col(right_span[1])) & (F.col(right_span[0]) <= F.col(left_span[1]))
    once = F.col("_block") == F.greatest("_first_left", "_first_right")
    kept = met.filter(overlap & once)
    return kept.select(*left.columns, *[c for c in right.columns if c not in by])


#: Blocks whose totals are added up in one window.
TOGETHER = 4096


def _begins(totals: DataFrame, by: list[str]) -> DataFrame:
    """Sums of all blocks before, from ``by, _block, _total``: ``_k0 .. , _b, _begin``.

    Blocks are added up in groups of ``TOGETHER``; only the groups' totals of a
    key meet in one row."""
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))]
    blocks = totals.select(*keys, F.col("_block").alias("_b"), F.floor(F.col("_block") / TOGETHER).alias("_group"), "_total")
    groups = blocks.groupBy(*names, "_group").agg(F.sum("_total").alias("_sum"))
    listed = groups.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("_group", "_sum"))).alias("_all"))
    zero = F.lit(0).cast(dict(groups.dtypes)["_sum"])
    summed = F.transform("_all", lambda g, i: F.struct(g["_group"].alias("_g"), F.aggregate(
        F.slice("_all", 1, i), zero, lambda acc, x: (acc + x["_sum"]).cast(dict(groups.dtypes)["_sum"])).alias("_ahead")))
    ahead = listed.select(*[F.col(n).alias(f"_a{n}") for n in names], F.inline(summed))
    same = F.col("_group") == F.col("_g")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_a{n}"))
    before = Window.partitionBy(*names, "_group").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.join(ahead, same).select(
        *names, "_b", (F.col("_ahead") + F.coalesce(F.sum("_total").over(before), F.lit(0))).alias("_begin"))


def running_total(
    df: DataFrame, by: Sequence[str], order: str, value: str, width: float, ties: Sequence[str] = (), name: str = "running_total",
) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the same ``by`` up to and
    with this one, by ``order`` and then ``ties`` (which should tell rows apart).

    Totals per block of ``width`` are added up first (one row per key and
    block), then each block runs its own window on top of what came before it.
    ``by`` may be empty: one group of all rows, which still splits.  NULL values
    count as nothing; rows with a NULL ``order`` come first.
    """
    by = list(by)
    blocked = df.withColumn("_block", F.coalesce(block_of(df, order, width), F.lit(-(1 << 62))))
    totals = blocked.groupBy(*by, "_block").agg(F.coalesce(F.sum(value), F.lit(0)).alias("_total"))
    begins = _begins(totals, by)
    same = F.col("_block") == F.col("_b")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*by, "_block").orderBy(F.col(order).asc_nulls_first(), *ties).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    total = F.col("_begin") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return blocked.join(begins, same).withColumn(name, total).select(*df.columns, name)
