"""Q2: incidents at one premises type by part of day.

The HHMM time is padded to four characters, its first two digits read as the
hour, and the hour bucketed.  Two conventions for unknown times exist in the
original (the DataFrame form files them under Night, the line-by-line form
drops them); ``invalid`` selects one.  Four output groups: the partial count
per task makes the shuffle a handful of rows whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.timeparts import hour_of_hhmm, part_of_day
from blotter.operators.aggregates import count_by
from blotter.operators.filters import code_filter, drop_malformed
from blotter.plans.standins import EVENTS_CSV_FIELDS, event_incidents, events_csv, hhmm_sql
from blotter.sources.files import read_csv, read_delimited

EVENTS_CSV_DDL = (
    "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, `TIME OCC` INT"
)

NULL_EVERY = 37


def part_of_day_counts(
    df: DataFrame, time_col: str, invalid: str = "other", pad: str = "lpad"
) -> DataFrame:
    """``part_day, n`` ordered by count descending.

    ``invalid='other'``: unknown hours count as Night; ``'drop'``: rows
    without a readable hour are left out.
    """
    if invalid not in ("other", "drop"):
        raise ValueError(f"invalid must be 'other' or 'drop', got {invalid!r}")
    # The hour gets its own projection: the bucket tests read it several
    # times, and a column reference is parsed once per row.
    hours = df.select(hour_of_hhmm(time_col, pad).alias("_hour"))
    part = part_of_day("_hour", "other" if invalid == "other" else "null").alias("part_day")
    parts = hours.select(part)
    if invalid == "drop":
        parts = parts.filter(F.col("part_day").isNotNull())
    return count_by(parts, "part_day").orderBy(F.col("n").desc(), F.col("part_day").asc())


def q_hhmm_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_incidents(spark, sf_dir)
    return count_by(ev.select(hour_of_hhmm("hhmm").alias("hour")), "hour")


def q_part_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = code_filter(event_incidents(spark, sf_dir), "event_type", "purchase")
    return part_of_day_counts(ev, "hhmm")


def q_part_of_day_null_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = code_filter(event_incidents(spark, sf_dir, NULL_EVERY), "event_type", "purchase")
    return part_of_day_counts(ev, "hhmm", invalid="other")


def q_part_of_day_null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = code_filter(event_incidents(spark, sf_dir, NULL_EVERY), "event_type", "purchase")
    return part_of_day_counts(ev, "hhmm", invalid="drop", pad="zfill")


def q_drop_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_incidents(spark, sf_dir)
    text = F.when(F.col("event_id") % NULL_EVERY == 0, F.lit("xx")).otherwise(
        F.col("hhmm").cast("string")
    )
    kept = drop_malformed(ev.select(text.alias("TIME OCC")), "TIME OCC", "int")
    return kept.agg(F.count(F.lit(1)).alias("n"))


def q_part_of_day_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 in its line-by-line form: positional fields of the text export,
    string equality on the type field, zfill padding, unreadable hours
    dropped.  An empty time field pads to ``0000`` (hour 0, Night); a line
    too short to have the field is dropped."""
    pos = {name: i for i, name in enumerate(EVENTS_CSV_FIELDS)}
    lines = read_delimited(
        spark, events_csv(spark, sf_dir, NULL_EVERY),
        {"event_type": pos["event_type"], "TIME OCC": pos["TIME OCC"]},
    )
    purchases = lines.filter(F.col("event_type") == F.lit("purchase"))
    return part_of_day_counts(purchases, "TIME OCC", invalid="drop", pad="zfill")


def q_part_of_day_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The DataFrame form over the CSV export: typed code filter, lpad,
    unknown times counted as Night."""
    ev = read_csv(spark, events_csv(spark, sf_dir, NULL_EVERY), schema=EVENTS_CSV_DDL)
    return part_of_day_counts(code_filter(ev, "event_type", "purchase"), "TIME OCC")


def _bucket_sql(hour: str) -> str:
    return f"""CASE WHEN {hour} BETWEEN 5 AND 11 THEN 'Morning'
            WHEN {hour} BETWEEN 12 AND 16 THEN 'Afternoon'
            WHEN {hour} BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END"""


def _part_sql(hhmm: str) -> str:
    return _bucket_sql(f"CAST(substr(lpad(CAST({hhmm} AS VARCHAR), 4, '0'), 1, 2) AS INTEGER)")


QUERIES = {
    "hhmm_hour": q_hhmm_hour,
    "part_of_day": q_part_of_day,
    "part_of_day_null_other": q_part_of_day_null_other,
    "part_of_day_null_drop": q_part_of_day_null_drop,
    "drop_malformed": q_drop_malformed,
    "part_of_day_text": q_part_of_day_text,
    "part_of_day_csv": q_part_of_day_csv,
}

_TEXT_HOUR = "TRY_CAST(substr(lpad(t, CAST(greatest(4, length(t)) AS INTEGER), '0'), 1, 2) AS INTEGER)"

ORACLE = {
    "part_of_day_text": f"""WITH t AS (
  SELECT COALESCE(CAST({hhmm_sql(NULL_EVERY)} AS VARCHAR), '') AS t FROM events
  WHERE event_type = 'purchase'),
h AS (SELECT {_TEXT_HOUR} AS h FROM t)
SELECT {_bucket_sql('h')} AS part_day, COUNT(*) AS n FROM h WHERE h IS NOT NULL GROUP BY 1""",
    "hhmm_hour": f"""SELECT CAST(substr(lpad(CAST({hhmm_sql()} AS VARCHAR), 4, '0'), 1, 2) AS INTEGER) AS hour,
       COUNT(*) AS n FROM events GROUP BY 1""",
    "part_of_day": f"""SELECT {_part_sql(hhmm_sql())} AS part_day, COUNT(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY 1""",
    "part_of_day_null_other": f"""SELECT {_part_sql(hhmm_sql(NULL_EVERY))} AS part_day, COUNT(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY 1""",
    "part_of_day_csv": f"""SELECT {_part_sql(hhmm_sql(NULL_EVERY))} AS part_day, COUNT(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY 1""",
    "part_of_day_null_drop": f"""SELECT {_part_sql(hhmm_sql(NULL_EVERY))} AS part_day, COUNT(*) AS n
FROM events WHERE event_type = 'purchase' AND {hhmm_sql(NULL_EVERY)} IS NOT NULL GROUP BY 1""",
    "drop_malformed": f"""SELECT COUNT(*) AS n FROM events
WHERE TRY_CAST(CASE WHEN event_id % {NULL_EVERY} = 0 THEN 'xx'
                    ELSE CAST({hhmm_sql()} AS VARCHAR) END AS INTEGER) IS NOT NULL""",
}
