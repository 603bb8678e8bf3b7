"""Filters, code handling and currency cleaning on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from blotter.functions.text import parse_currency
from blotter.operators.aggregates import count_by, decode_codes
from blotter.operators.filters import (
    code_filter,
    drop_null_island,
    prefix_filter,
    require_not_null,
)
from blotter.plans.standins import lat_sql, line_incidents, lon_sql, table

# Order status labels used as the stand-in code table.
STATUS_LABELS = {"F": "Filled", "O": "Open"}


def q_code_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return code_filter(part, "p_size", "11")


def q_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_size")
    return count_by(prefix_filter(part, "p_size", "1"), "p_size")


def q_not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    victims = ev.select(
        "event_type",
        F.nullif(F.col("event_type"), F.lit("error")).alias("Vict Sex"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None)).otherwise(F.col("props")).alias("Vict Descent"),
    )
    return count_by(require_not_null(victims, ["Vict Sex", "Vict Descent"]), "event_type")


def q_null_island(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_null_island(line_incidents(spark, sf_dir), "LAT", "LON")
    return kept.agg(F.count(F.lit(1)).alias("n"))


def q_currency_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals exported as ``$12,345`` text (``n/a`` for low priority),
    parsed back; unparseable amounts are NULL and not counted."""
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a")).otherwise(
        F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0))
    )
    amounts = o.select("o_orderstatus", parse_currency(text, LongType()).alias("amount"))
    return amounts.groupBy("o_orderstatus").agg(
        F.count("amount").alias("n_parsed"), F.sum("amount").alias("total")
    )


def q_decode_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode after counting: the lookup runs on one row per code, then
    counts are re-added in case two codes share a label."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"))
    per_code = count_by(o, "status")
    decoded = decode_codes(per_code, "status", STATUS_LABELS)
    return decoded.groupBy("status").agg(F.sum("n").alias("n"))


_STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE o_orderstatus END"

QUERIES = {
    "code_filter": q_code_filter,
    "prefix_filter": q_prefix_filter,
    "not_null_filter": q_not_null_filter,
    "null_island": q_null_island,
    "currency_clean": q_currency_clean,
    "decode_status": q_decode_status,
}

ORACLE = {
    "code_filter": "SELECT p_partkey, p_size FROM part WHERE p_size = 11",
    "prefix_filter": """SELECT p_size, COUNT(*) AS n FROM part
WHERE starts_with(CAST(p_size AS VARCHAR), '1') GROUP BY 1""",
    "not_null_filter": """SELECT event_type, COUNT(*) AS n FROM events
WHERE NULLIF(event_type, 'error') IS NOT NULL
  AND (CASE WHEN user_id % 5 = 0 THEN NULL ELSE props END) IS NOT NULL
GROUP BY 1""",
    "null_island": f"""SELECT COUNT(*) AS n FROM (
  SELECT CASE WHEN l_partkey % 50 = 0 THEN 0.0::DOUBLE ELSE {lat_sql('l_orderkey')} END AS lat,
         {lon_sql('l_orderkey')} AS lon
  FROM lineitem) WHERE lat <> 0 AND lon <> 0""",
    "currency_clean": """SELECT o_orderstatus, COUNT(amount) AS n_parsed, CAST(SUM(amount) AS BIGINT) AS total
FROM (SELECT o_orderstatus,
             TRY_CAST(regexp_replace(CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a'
                      ELSE '$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) END,
                      '[$,]', '', 'g') AS BIGINT) AS amount
      FROM orders) GROUP BY 1""",
    "decode_status": f"SELECT {_STATUS_SQL} AS status, COUNT(*) AS n FROM orders GROUP BY 1",
}
