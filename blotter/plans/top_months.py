"""Q1: the three months with the most incidents in each year.

Plan shape: scan -> year/month projection -> partial count -> shuffle of
(year, month) partials -> final count -> WindowGroupLimit -> rank -> filter
-> sort.  Only the partial counts cross the network; the window sees at
most twelve rows per year.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.text import INCIDENT_TS_FORMAT, parse_ts
from blotter.operators.aggregates import count_by
from blotter.operators.ranking import top_k_per_group
from blotter.plans.standins import ORDERS_CSV_DDL, order_incidents, orders_csv, table
from blotter.sources.files import read_csv


def _ts(df: DataFrame, column: str, fmt: str | None):
    return parse_ts(column, fmt) if fmt else F.col(column)


def monthly_counts(df: DataFrame, column: str, fmt: str | None = None, name: str = "n") -> DataFrame:
    """Incidents per (year, month); ``fmt`` parses a text column first
    (malformed dates form the NULL year/month group)."""
    # Parsed once in its own projection; year and month both read it.
    stamped = df.select(_ts(df, column, fmt).alias("_ts"))
    months = stamped.select(F.year("_ts").alias("year"), F.month("_ts").alias("month"))
    return count_by(months, ["year", "month"], name)


def top_months(
    df: DataFrame, column: str, fmt: str | None = None, k: int = 3, method: str = "rank"
) -> DataFrame:
    """``year, month, incident_total, ranking`` for the top-k months per year,
    ordered by year, then count descending (month breaks ties)."""
    counts = monthly_counts(df, column, fmt, "incident_total")
    top = top_k_per_group(counts, ["year"], [F.col("incident_total").desc()], k, method)
    return top.orderBy(F.col("year").asc(), F.col("incident_total").desc(), F.col("month").asc())


TOP_MONTHS_SQL = """
SELECT m.*
FROM (SELECT year(at) AS year, month(at) AS month, count(*) AS incident_total,
             rank() OVER (PARTITION BY year(at) ORDER BY count(*) DESC) AS ranking
      FROM {occurred}
      GROUP BY year(at), month(at)) AS m
WHERE m.ranking <= :k
ORDER BY m.year, m.ranking, m.month"""


def top_months_sql(
    spark: SparkSession, df: DataFrame, column: str, fmt: str | None = None, k: int = 3
) -> DataFrame:
    """The same question as one SQL statement over the DataFrame: the window
    ranks the groups of the same SELECT, and equal counts are listed by month."""
    occurred = df.select(_ts(df, column, fmt).alias("at"))
    return spark.sql(TOP_MONTHS_SQL, args={"k": k}, occurred=occurred)


def months_of_year(df: DataFrame, column: str, year: int, fmt: str) -> DataFrame:
    """``month, n`` of one year of a text column.

    Year and month read one parsed value and the year is tested while
    counting: a filter would move below the projection and parse again."""
    stamped = df.select(parse_ts(column, fmt).alias("_ts"))
    parts = stamped.select(F.year("_ts").alias("_year"), F.month("_ts").alias("month"))
    counted = parts.groupBy("month").agg(F.count_if(F.col("_year") == year).alias("n"))
    return counted.filter(F.col("n") > 0)


# ------------------------------------------------------------------ roster
def q_monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_counts(table(spark, sf_dir, "orders"), "o_orderdate")


def q_monthly_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"orders_{uuid.uuid4().hex[:8]}"
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    result = spark.sql(
        f"""SELECT year, month, COUNT(*) AS n
            FROM (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month FROM {view})
            GROUP BY year, month"""
    )
    spark.catalog.dropTempView(view)
    return result


def q_top_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_months(order_incidents(spark, sf_dir), "o_orderdate")


def q_top_months_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_months_sql(spark, table(spark, sf_dir, "orders"), "o_orderdate")


def q_top_months_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_csv(spark, orders_csv(spark, sf_dir), schema=ORDERS_CSV_DDL)
    return top_months(df, "date_occ", INCIDENT_TS_FORMAT)


def q_top_months_sql_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL form over the CSV export: the 12-hour text is parsed in SQL."""
    df = read_csv(spark, orders_csv(spark, sf_dir), schema=ORDERS_CSV_DDL)
    return top_months_sql(spark, df, "date_occ", INCIDENT_TS_FORMAT)


def q_year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of 1997 by month after a round trip through 12-hour date text."""
    o = table(spark, sf_dir, "orders")
    text = o.select(F.date_format("o_orderdate", INCIDENT_TS_FORMAT).alias("DATE OCC"))
    return months_of_year(text, "DATE OCC", 1997, INCIDENT_TS_FORMAT)


_MONTHLY_SQL = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS {name}
FROM orders GROUP BY 1, 2"""

_TOP_SQL = f"""WITH agg AS ({_MONTHLY_SQL.format(name='incident_total')}),
ranked AS (
  SELECT year, month, incident_total,
         CAST(RANK() OVER (PARTITION BY year ORDER BY incident_total DESC) AS INTEGER) AS ranking
  FROM agg)
SELECT year, month, incident_total, ranking FROM ranked WHERE ranking <= 3
ORDER BY year, incident_total DESC, month"""

QUERIES = {
    "monthly_counts": q_monthly_counts,
    "monthly_counts_sql": q_monthly_counts_sql,
    "top_months": q_top_months,
    "top_months_sql": q_top_months_sql,
    "top_months_csv": q_top_months_csv,
    "top_months_sql_csv": q_top_months_sql_csv,
    "year_filter": q_year_filter,
}

ORACLE = {
    "monthly_counts": _MONTHLY_SQL.format(name="n"),
    "monthly_counts_sql": _MONTHLY_SQL.format(name="n"),
    "top_months": _TOP_SQL,
    "top_months_sql": _TOP_SQL,
    "top_months_csv": _TOP_SQL,
    "top_months_sql_csv": _TOP_SQL,
    "year_filter": """SELECT CAST(month(d) AS INTEGER) AS month, COUNT(*) AS n
FROM (SELECT try_strptime(strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p'), '%m/%d/%Y %I:%M:%S %p') AS d
      FROM orders)
WHERE year(d) = 1997 GROUP BY 1""",
}
