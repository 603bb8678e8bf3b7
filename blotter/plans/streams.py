"""Events that arrive late and out of order, counted in windows and sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.plans.standins import TABLE_SCHEMAS, table
from blotter.session import scratch_path
from blotter.streaming.windows import append_to, sessions, windowed

#: Arrivals cover six days of events each; every fifth event comes one arrival late.
FIRST_DAY, ARRIVALS, DAYS = "2024-01-01", 6, 6


def _streamed(spark: SparkSession, sf_dir: str, results: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run the stream once per arrival, each run restarted from the checkpoint."""
    src, out = scratch_path(spark, "events-arriving"), scratch_path(spark, "events-windows")
    events = table(spark, sf_dir, "events")
    day = F.date_diff(F.col("ts").cast("date"), F.lit(FIRST_DAY).cast("date"))
    arrival = F.least(F.lit(ARRIVALS - 1), F.floor(day / DAYS) + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0))
    for k in range(ARRIVALS):
        events.filter(arrival == k).write.mode("append").parquet(src)
        stream = spark.readStream.schema(TABLE_SCHEMAS["events"]).parquet(src)
        append_to(results(stream), out).awaitTermination()
    return spark.read.parquet(out)


def q_stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type in windows of 12 hours every 6 hours; four days' delay is
    allowed, so some of the rows that come six days late are left out."""
    return _streamed(spark, sf_dir, lambda s: windowed(s, "ts", "12 hours", "6 hours", "4 days", ["event_type"])).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a user with gaps under 8 hours; no row is too late for
    fourteen days' delay, so sessions are those of the whole table."""
    found = _streamed(spark, sf_dir, lambda s: sessions(s, "ts", "8 hours", "14 days", ["user_id"]))
    return found.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("begins"),
                        F.col("window_end").cast("timestamp_ntz").alias("ends"), "n")


_ARRIVED = f"""arrived AS (
  SELECT *, least({ARRIVALS - 1}, floor(date_diff('day', DATE '{FIRST_DAY}', CAST(ts AS DATE)) / {DAYS})
                  + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) AS arrival
  FROM events)"""

QUERIES = {"stream_windows": q_stream_windows, "stream_sessions": q_stream_sessions}

ORACLE = {
    "stream_windows": f"""WITH {_ARRIVED},
seen AS (SELECT arrival, MAX(MAX(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 4 DAYS AS mark
         FROM arrived GROUP BY arrival),
placed AS (SELECT event_type, arrival, time_bucket(INTERVAL 6 HOURS, ts) - back * INTERVAL 6 HOURS AS window_start
           FROM arrived, (SELECT unnest([0, 1]) AS back))
SELECT window_start, event_type, COUNT(*) AS n
FROM placed JOIN seen USING (arrival)
WHERE (mark IS NULL OR window_start + INTERVAL 12 HOURS > mark)
  AND window_start + INTERVAL 12 HOURS <= (SELECT MAX(ts) - INTERVAL 4 DAYS FROM events)
GROUP BY 1, 2""",
    "stream_sessions": """WITH marked AS (
  SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 8 HOURS THEN 0 ELSE 1 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS nth FROM marked)
SELECT user_id, MIN(ts) AS begins, MAX(ts) + INTERVAL 8 HOURS AS ends, COUNT(*) AS n
FROM numbered GROUP BY user_id, nth
HAVING MAX(ts) + INTERVAL 8 HOURS <= (SELECT MAX(ts) - INTERVAL 14 DAYS FROM events)""",
}
