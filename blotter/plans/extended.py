"""Mixed and malformed exports, and joins over distance, time and skewed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.filters import code_filter
from blotter.operators.heavy import join_heavy
from blotter.operators.nearby import geo_near
from blotter.operators.sketches import answered, rolled_up, sketched
from blotter.operators.temporal import asof_join, interval_join, running_total
from blotter.plans.formats import _KEY_RANGE_SQL, key_range_by_status
from blotter.plans.standins import GEO_SQL, ORDERS_CSV_DDL, geo_lookup, lat_of, lat_sql, orders_csv, place_lon, place_lon_sql, table
from blotter.session import scratch_path
from blotter.sources.files import read_csv
from blotter.sources.quarantine import quarantine, read_csv_ledger
from blotter.sources.sinks import write_csv


# ------------------------------------------------------------ mixed headers
def q_scan_csv_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder whose files have three header orders, one with an undeclared column."""
    folder = scratch_path(spark, "orders-mixed-csv")
    rows = spark.read.option("header", True).csv(orders_csv(spark, sf_dir)).drop("file_no")
    third = F.col("o_orderkey").cast("bigint") % 3
    for k, names in enumerate([
            rows.columns, rows.columns[::-1],
            ["o_orderstatus", "o_orderkey", "remark", "o_totalprice", "date_occ", "o_custkey", "o_orderpriority"]]):
        write_csv(rows.filter(third == k).withColumn("remark", F.lit("none")).select(*names), folder, mode="append")
    return key_range_by_status(read_csv(spark, folder, schema=ORDERS_CSV_DDL))


# ------------------------------------------------------------ malformed rows
DIRTY_DDL = "o_orderkey BIGINT NOT NULL, o_custkey BIGINT, o_orderstatus STRING, o_totalprice BIGINT"


def dirty_orders(spark: SparkSession, sf_dir: str) -> str:
    """orders as lines of text; by key some have a bad or no key, a bad total,
    or a field too many."""
    k = F.col("o_orderkey")
    key = F.when(k % 107 == 0, "").when(k % 101 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string"))
    total = F.when(k % 103 == 0, "n/a").otherwise(F.floor("o_totalprice").cast("string"))
    line = F.concat(F.concat_ws(",", key, F.col("o_custkey").cast("string"), "o_orderstatus", total), F.when(k % 97 == 0, ",extra").otherwise(""))
    path = scratch_path(spark, "orders-dirty")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return path


def _quarantined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ledger = read_csv_ledger(spark, dirty_orders(spark, sf_dir), DIRTY_DDL, header=False)
    return quarantine(ledger, scratch_path(spark, "orders-quarantine"))


def q_quarantine_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _ = _quarantined(spark, sf_dir)
    return clean.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"), F.sum("o_totalprice").alias("total"))


def q_quarantine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = _quarantined(spark, sf_dir)
    return rejects.select("o_custkey", F.array_join("_reasons", "; ").alias("reasons"), F.coalesce("_raw", F.lit("")).alias("raw"))


_DIRTY_SQL = """dirty AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS total,
         o_orderkey % 97 = 0 AS extra, o_orderkey % 107 = 0 AS no_key, o_orderkey % 101 = 0 AND o_orderkey % 107 <> 0 AS bad_key,
         o_orderkey % 103 = 0 AS bad_total
  FROM orders)"""


# ------------------------------------------------------------ decimals
def q_code_filter_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes against a decimal column; ``0.055`` is none of its values."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_discount").cast("decimal(4,2)").alias("rate"))
    found = [code_filter(lines, "rate", code).withColumn("code", F.lit(code)) for code in ("0.05", "0.055", "0.060")]
    both = found[0].unionByName(found[1]).unionByName(found[2])
    return both.groupBy("code", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ joins
TOLERANCE_KM = 0.01


def _sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders a few metres off their customer's place, in either direction."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 53 != 0, lat_of("o_custkey") + (F.col("o_orderkey") % 5 - 2).cast("double") / F.lit(50000.0)).alias("lat"),
        (place_lon("o_custkey") + (F.col("o_orderkey") % 7 + 1).cast("double") / F.lit(4000000.0)).alias("lon"))


def q_geo_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders counted by the ZIP of the nearest known place within 10 metres."""
    met = geo_near(_sightings(spark, sf_dir), geo_lookup(spark, sf_dir), TOLERANCE_KM)
    return met.groupBy("zip").agg(F.count(F.lit(1)).alias("n"))


def q_join_heavy_hitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines joined to their supplier; a third of them have one supplier."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("l_suppkey")).alias("s_suppkey"),
        "l_orderkey", "l_linenumber", "l_quantity")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    met = join_heavy(lines, supplier, "s_suppkey", by=["l_orderkey", "l_linenumber"])
    return met.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


DAY = 86_400.0


def q_asof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's last click at or before it."""
    events = table(spark, sf_dir, "events")
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.filter("event_type = 'click'").select("user_id", "ts", F.col("value").alias("click_value"))
    return asof_join(purchases, clicks, on="ts", by=["user_id"], cols=["click_value"], width=DAY)


def q_interval_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a user within six hours after a view, counted by view."""
    events = table(spark, sf_dir, "events")
    views = events.filter("event_type = 'view'").select(
        "event_id", "user_id", F.col("ts").alias("opened"), (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("closed"))
    errors = events.filter("event_type = 'error'").select("user_id", F.col("ts").alias("failed"), F.col("event_id").alias("error_id"))
    met = interval_join(views, errors, ["user_id"], ("opened", "closed"), ("failed", "failed"), width=6 * 3600.0)
    return met.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.min("error_id").alias("first_error"))


def q_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals over all events as one group."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return running_total(events, [], "ts", "cents", DAY, ties=["event_id"]).select("event_id", "running_total")


def q_sketch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and median value by event type, rolled up from a stored table of
    daily sketches, and whether both are within three standard errors."""
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    path = scratch_path(spark, "daily-sketches")
    sketched(events, ["day", "event_type"], "user_id", "value").write.parquet(path)
    found = answered(rolled_up(spark.read.parquet(path), ["event_type"]))
    median = F.get("quantiles", 0)
    met = events.join(found.drop("n"), "event_type")
    checked = met.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.first("distinct_estimate").alias("estimate"),
        (F.count_if(F.col("value") <= median) / F.count("value")).alias("rank"))
    return checked.select(
        "event_type", "n", (F.abs(F.col("estimate") / F.col("users") - 1) < 0.05).alias("users_ok"),
        (F.abs(F.col("rank") - 0.5) < 0.025).alias("median_ok"))


def _haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    return f"(12742.0 * asin(sqrt(least(1.0, {a}))))"


QUERIES = {
    "scan_csv_mixed_folder": q_scan_csv_mixed_folder,
    "quarantine_clean": q_quarantine_clean,
    "quarantine_rejects": q_quarantine_rejects,
    "code_filter_decimal": q_code_filter_decimal,
    "geo_near": q_geo_near,
    "join_heavy_hitter": q_join_heavy_hitter,
    "asof_events": q_asof_events,
    "interval_events": q_interval_events,
    "running_total": q_running_total,
    "sketch_rollup": q_sketch_rollup,
}

ORACLE = {
    "scan_csv_mixed_folder": _KEY_RANGE_SQL,
    "quarantine_clean": f"""WITH {_DIRTY_SQL}
SELECT o_orderstatus, COUNT(*) AS n, MIN(k) AS lo, MAX(k) AS hi, CAST(SUM(total) AS BIGINT) AS total
FROM dirty WHERE NOT extra AND NOT no_key AND NOT bad_key AND NOT bad_total GROUP BY 1""",
    "quarantine_rejects": f"""WITH {_DIRTY_SQL}
SELECT o_custkey,
       CASE WHEN extra THEN 'fields: malformed record'
            ELSE array_to_string(list_filter([
                   CASE WHEN bad_key THEN 'o_orderkey: x' || k || ' is no bigint' END,
                   CASE WHEN no_key THEN 'o_orderkey: missing' END,
                   CASE WHEN bad_total THEN 'o_totalprice: n/a is no bigint' END], lambda x: x IS NOT NULL), '; ') END AS reasons,
       CASE WHEN extra THEN (CASE WHEN no_key THEN '' WHEN bad_key THEN 'x' || k ELSE CAST(k AS VARCHAR) END) || ',' || o_custkey
                 || ',' || o_orderstatus || ',' || (CASE WHEN bad_total THEN 'n/a' ELSE CAST(total AS VARCHAR) END) || ',extra'
            ELSE '' END AS raw
FROM dirty WHERE extra OR no_key OR bad_key OR bad_total""",
    "code_filter_decimal": """SELECT code, l_returnflag, COUNT(*) AS n
FROM (SELECT '0.05' AS code, 0.05 AS v UNION ALL SELECT '0.055', 0.055 UNION ALL SELECT '0.060', 0.060)
JOIN (SELECT l_returnflag, CAST(l_discount AS DECIMAL(4,2)) AS rate FROM lineitem) ON rate = v GROUP BY 1, 2""",
    "geo_near": f"""WITH {GEO_SQL},
facts AS (
  SELECT CASE WHEN o_orderkey % 53 <> 0 THEN {lat_sql('o_custkey')} + CAST(o_orderkey % 5 - 2 AS DOUBLE) / 50000.0::DOUBLE END AS flat,
         {place_lon_sql('o_custkey')} + CAST(o_orderkey % 7 + 1 AS DOUBLE) / 4000000.0::DOUBLE AS flon, o_orderkey
  FROM orders),
best AS (
  SELECT o_orderkey, arg_min(zip, km) AS zip
  FROM (SELECT o_orderkey, zip, {_haversine_sql('flat', 'flon', 'lat', 'lon')} AS km
        FROM facts JOIN geo ON lat BETWEEN flat - 0.0002 AND flat + 0.0002)
  WHERE km <= {TOLERANCE_KM} GROUP BY 1)
SELECT zip, COUNT(*) AS n FROM facts LEFT JOIN best USING (o_orderkey) GROUP BY 1""",
    "join_heavy_hitter": """SELECT s_nationkey, COUNT(*) AS n, SUM(l_quantity) AS quantity
FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS s_suppkey, l_quantity FROM lineitem)
JOIN supplier USING (s_suppkey) GROUP BY 1""",
    "asof_events": """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, ts, MAX(value) AS click_value FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT p.event_id, p.user_id, p.ts, c.ts AS asof_ts, c.click_value
FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts >= c.ts""",
    "interval_events": """SELECT v.event_id, COUNT(*) AS n, MIN(e.event_id) AS first_error
FROM events v JOIN events e ON v.user_id = e.user_id AND e.ts BETWEEN v.ts AND v.ts + INTERVAL 6 HOURS
WHERE v.event_type = 'view' AND e.event_type = 'error' GROUP BY 1""",
    "sketch_rollup": "SELECT event_type, COUNT(*) AS n, true AS users_ok, true AS median_ok FROM events GROUP BY 1",
    "running_total": """SELECT event_id, CAST(SUM(CAST(round(value * 100) AS BIGINT)) OVER (ORDER BY ts, event_id) AS BIGINT) AS running_total
FROM events""",
}
