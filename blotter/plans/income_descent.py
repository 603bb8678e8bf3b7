"""Q3: victims by descent in the richest and poorest ZIP codes.

Facts are enriched with a ZIP code (left join on exact coordinates) and the
ZIP's median income (left join on the ZIP text), the top or bottom k ZIPs by
income are chosen, and victims in those ZIPs are counted by decoded descent.

One lazy plan reads the facts once:

* The coordinate lookup is joined without a hint: within Spark's byte
  threshold it is broadcast and the facts stay where they are; a lookup that
  grows with the data is a shuffle join on the coordinates, where AQE splits a
  hot point.  Counts per ``(zip, code)`` follow, partial per task.
* Incomes are joined to those counts, and each ZIP becomes one row: its
  income and the list of its (code, count) pairs, as long as there are codes.
* Top-k is ``orderBy + limit`` (TakeOrderedAndProject, bounded) on the ZIP
  rows; the chosen rows already hold their counts, so nothing is read again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.codes import DESCENT_CODES
from blotter.functions.text import parse_currency
from blotter.operators.aggregates import decode_codes
from blotter.operators.filters import require_not_null, year_filter
from blotter.operators.joins import geo_enrich, join_with_strategy
from blotter.operators.naming import rename_strict
from blotter.operators.ranking import top_k_groups
from blotter.plans.standins import (
    GEO_SQL,
    INC_SQL,
    geo_lookup,
    income_raw,
    order_facts_sql,
    order_incidents,
)

# Year of the year-restricted variant (a filter on the stored timestamp).
YEAR = 1998


def clean_income(raw: DataFrame) -> DataFrame:
    """``Zip Code, Estimated Median Income`` text -> ``zip`` (string), ``income`` (int).

    Rows without a ZIP are dropped; unparseable amounts become NULL.  The ZIP
    stays text on both sides of the join, so ``'90001-22'`` cannot fail a cast.
    """
    renamed = rename_strict(raw, {"Zip Code": "zip", "Estimated Median Income": "income"})
    return renamed.dropna(subset=["zip"]).select(
        F.col("zip").cast("string").alias("zip"), parse_currency("income").alias("income")
    )


def zip_status_counts(
    facts: DataFrame,
    geo: DataFrame,
    income: DataFrame,
    strategy: str | None = None,
    code_col: str = "status",
) -> DataFrame:
    """``zip, status, n, income``: incident counts per ZIP and code.

    Facts need ``lat, lon`` and ``code_col``.  ZIP is NULL for incidents at
    points missing from ``geo``; income is NULL for ZIPs missing from it.
    Duplicate lookup rows fan out.  ``strategy`` hints both lookup joins.
    """
    located = geo_enrich(facts.select("lat", "lon", code_col), geo, ["lat", "lon"], ["zip"], strategy)
    per_zip = located.groupBy("zip", code_col).agg(F.count(F.lit(1)).alias("n"))
    return join_with_strategy(per_zip, income, "zip", "left", strategy)


def victims_by_descent(
    counts: DataFrame,
    k: int | None = 3,
    ascending: bool = False,
    nulls: str = "drop",
    mapping: Mapping[str, str] = DESCENT_CODES,
    code_col: str = "status",
) -> DataFrame:
    """``<code_col>, n`` for incidents in the top (or bottom) k ZIPs by income.

    Incidents without a ZIP are in no chosen ZIP, even if the NULL group
    takes one of the k places.
    """
    codes = F.collect_list(F.struct(F.col(code_col), "n")).alias("_codes")
    zips = top_k_groups(counts, "zip", "income", k, ascending, nulls, sort=False, also=[codes])
    chosen = zips.filter(F.col("zip").isNotNull()).select(F.inline("_codes"))
    per_code = chosen.groupBy(code_col).agg(F.sum("n").alias("n"))
    out = decode_codes(per_code, code_col, mapping).groupBy(code_col).agg(F.sum("n").alias("n"))
    return out.orderBy(F.col("n").desc(), F.col(code_col).asc_nulls_first())


# ------------------------------------------------------------------ roster
def _counts(spark: SparkSession, sf_dir: str, strategy: str | None = None) -> DataFrame:
    facts = require_not_null(order_incidents(spark, sf_dir), ["status", "priority"])
    return zip_status_counts(facts, geo_lookup(spark, sf_dir), clean_income(income_raw(spark, sf_dir)), strategy)


def q_descent_top_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-3 ZIP victims for one year; the year test reaches the Parquet scan."""
    facts = year_filter(order_incidents(spark, sf_dir), "o_orderdate", YEAR)
    facts = require_not_null(facts, ["status", "priority"])
    counts = zip_status_counts(facts, geo_lookup(spark, sf_dir), clean_income(income_raw(spark, sf_dir)))
    return victims_by_descent(counts, 3, ascending=False)


def q_geo_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = require_not_null(order_incidents(spark, sf_dir), ["status", "priority"])
    points = facts.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"))
    enriched = geo_enrich(points, geo_lookup(spark, sf_dir), ["lat", "lon"], ["zip"])
    return enriched.groupBy("zip").agg(F.sum("n").alias("n"))


def q_income_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _counts(spark, sf_dir)
    flag = F.col("income").isNotNull().cast("int").alias("has_income")
    return counts.select(flag, "n").groupBy("has_income").agg(F.sum("n").alias("n"))


def q_top_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_groups(_counts(spark, sf_dir), "zip", "income", 3, ascending=False)


def q_bottom_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_groups(_counts(spark, sf_dir), "zip", "income", 3, ascending=True)


def q_bottom_zips_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_groups(_counts(spark, sf_dir), "zip", "income", 3, ascending=True, nulls="first")


def q_descent_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return victims_by_descent(_counts(spark, sf_dir), 3, ascending=False)


def q_descent_top_nolimit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return victims_by_descent(_counts(spark, sf_dir), None, ascending=False, nulls="last")


def q_descent_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return victims_by_descent(_counts(spark, sf_dir), 3, ascending=True)


def q_descent_bottom_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom 3 as originally sorted: ZIPs without income come first (the
    NULL-ZIP group can take a slot and then matches no incident)."""
    return victims_by_descent(_counts(spark, sf_dir), 3, ascending=True, nulls="first")


def descent_bottom_with(strategy: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return victims_by_descent(_counts(spark, sf_dir, strategy), 3, ascending=True)

    run.__name__ = f"q_join_{strategy}"
    return run


def _enriched_sql(facts_sql: str) -> str:
    return f"""WITH {GEO_SQL},
{INC_SQL},
{facts_sql},
enriched AS (
  SELECT f.status, g.zip, i.income FROM facts f
  LEFT JOIN geo g ON f.lat = g.lat AND f.lon = g.lon
  LEFT JOIN inc i ON g.zip = i.zip),
zips AS (SELECT zip, MAX(income) AS income FROM enriched GROUP BY zip)"""


_ENRICHED_SQL = _enriched_sql(order_facts_sql())

_DECODE_SQL = "CASE status " + " ".join(f"WHEN '{c}' THEN '{label}'" for c, label in DESCENT_CODES.items()) + " ELSE status END"


def _chosen_sql(order: str, keep_null: bool, limit: int | None) -> str:
    where = "" if keep_null else "WHERE income IS NOT NULL"
    lim = f"LIMIT {limit}" if limit else ""
    return f"SELECT zip, income FROM zips {where} ORDER BY {order} {lim}"


def _descent_sql(chosen: str, enriched: str = _ENRICHED_SQL) -> str:
    return f"""{enriched},
chosen AS ({chosen})
SELECT {_DECODE_SQL} AS status, COUNT(*) AS n FROM enriched
WHERE zip IN (SELECT zip FROM chosen) GROUP BY 1"""


_TOP = _chosen_sql("income DESC NULLS LAST, zip ASC NULLS LAST", False, 3)
_BOTTOM = _chosen_sql("income ASC NULLS LAST, zip ASC NULLS LAST", False, 3)
_BOTTOM_NULLS_FIRST = _chosen_sql("income ASC NULLS FIRST, zip ASC NULLS FIRST", True, 3)
_ALL = _chosen_sql("income DESC NULLS LAST, zip ASC NULLS LAST", True, None)

QUERIES = {
    "geo_enrich": q_geo_enrich,
    "income_enrich": q_income_enrich,
    "top_zips": q_top_zips,
    "bottom_zips": q_bottom_zips,
    "bottom_zips_nulls_first": q_bottom_zips_nulls_first,
    "descent_top": q_descent_top,
    "descent_top_nolimit": q_descent_top_nolimit,
    "descent_bottom": q_descent_bottom,
    "descent_top_year": q_descent_top_year,
    "descent_bottom_nulls_first": q_descent_bottom_nulls_first,
    "join_broadcast": descent_bottom_with("broadcast"),
    "join_merge": descent_bottom_with("merge"),
    "join_shuffle_hash": descent_bottom_with("shuffle_hash"),
    "join_replicate_nl": descent_bottom_with("shuffle_replicate_nl"),
}

ORACLE = {
    "descent_top_year": _descent_sql(
        _TOP,
        _enriched_sql(
            order_facts_sql(
                f"o_orderdate >= TIMESTAMP '{YEAR}-01-01' AND o_orderdate < TIMESTAMP '{YEAR + 1}-01-01'"
            )
        ),
    ),
    "geo_enrich": f"""WITH {GEO_SQL},
{order_facts_sql()}
SELECT g.zip, COUNT(*) AS n FROM facts f
LEFT JOIN geo g ON f.lat = g.lat AND f.lon = g.lon GROUP BY 1""",
    "income_enrich": f"""{_ENRICHED_SQL}
SELECT CAST(income IS NOT NULL AS INTEGER) AS has_income, COUNT(*) AS n FROM enriched GROUP BY 1""",
    "top_zips": f"{_ENRICHED_SQL}\n{_TOP}",
    "bottom_zips": f"{_ENRICHED_SQL}\n{_BOTTOM}",
    "bottom_zips_nulls_first": f"{_ENRICHED_SQL}\n{_BOTTOM_NULLS_FIRST}",
    "descent_top": _descent_sql(_TOP),
    "descent_top_nolimit": _descent_sql(_ALL),
    "descent_bottom": _descent_sql(_BOTTOM),
    "descent_bottom_nulls_first": _descent_sql(_BOTTOM_NULLS_FIRST),
}
for _hint in ("broadcast", "merge", "shuffle_hash", "replicate_nl"):
    ORACLE[f"join_{_hint}"] = ORACLE["descent_bottom"]
