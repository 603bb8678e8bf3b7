"""Incident-shaped inputs derived from the driver's test tables.

The original incident, station, income and geocoding files are not
available, so each question runs on the generated tables re-aimed as below.
Every derived input is computed from a real table and grows with it.

Coordinates of key k:  lat = 33.7 + (k % 60) / 100,  lon = -118.6 + (k % 50) / 100
Places: every customer is one: lat as above, lon = -118.6 + k / 1000000.
GEO: a row per customer -> (place, zip = 90000 + k % 400); customers with k % 10 = 7
     are missing, with k % 89 = 0 have no latitude, with k % 97 = 0 occur twice
INC: a row per zip of the customers that k % 400 reaches -> income text
     '$' + thousands(20000 + (zip - 90000) * 7919 % 50000); zips with zip % 9 = 0 are missing
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions._col import ColumnOrName, as_col
from blotter.functions.codes import DESCENT_CODES
from blotter.functions.text import INCIDENT_TS_FORMAT
from blotter.session import scratch_path
from blotter.sources.sinks import write_csv

# Fixed values of the stand-in geography (see module docstring).
LAT0, LAT_STEPS = 33.7, 60
LON0, LON_STEPS = -118.6, 50
GEO_ZIPS, ZIP_BASE = 400, 90000
INCOME_BASE, INCOME_MULT, INCOME_SPAN = 20000, 7919, 50000


# Declared schemas of the generated test tables.  Declaring
# them skips the footer-reading job that schema inference runs per read.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated table, read with its declared schema when known."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lat_of(k: ColumnOrName) -> Column:
    return F.lit(LAT0) + (as_col(k) % LAT_STEPS).cast("double") / F.lit(100.0)


def lon_of(k: ColumnOrName) -> Column:
    return F.lit(LON0) + (as_col(k) % LON_STEPS).cast("double") / F.lit(100.0)


def lat_sql(k: str) -> str:
    return f"({LAT0}::DOUBLE + CAST({k} % {LAT_STEPS} AS DOUBLE) / 100.0::DOUBLE)"


def lon_sql(k: str) -> str:
    return f"({LON0}::DOUBLE + CAST({k} % {LON_STEPS} AS DOUBLE) / 100.0::DOUBLE)"


def place_lon(k: ColumnOrName) -> Column:
    """Longitude of a customer's place, different for every key."""
    return F.lit(LON0) + as_col(k).cast("double") / F.lit(1_000_000.0)


def place_lon_sql(k: str) -> str:
    return f"({LON0}::DOUBLE + CAST({k} AS DOUBLE) / 1000000.0::DOUBLE)"


# ---------------------------------------------------------------- dimensions
def geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reverse geocoding: (lat, lon) -> zip (string), a point per customer."""
    k = F.col("c_custkey")
    known = table(spark, sf_dir, "customer").select("c_custkey").filter(k % 10 != 7)
    times = F.explode(F.sequence(F.lit(1), F.when(k % 97 == 0, 2).otherwise(1))).alias("_copy")
    return known.select("c_custkey", times).select(
        F.when(k % 89 != 0, lat_of(k)).alias("lat"),
        place_lon(k).alias("lon"),
        (F.lit(ZIP_BASE) + k % GEO_ZIPS).cast("string").alias("zip"),
    )


def income_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income by zip as exported: ``Zip Code`` text, ``Estimated Median Income``
    as a currency string, plus rows without a zip (dropped by cleaning)."""
    nth = table(spark, sf_dir, "customer").select((F.col("c_custkey") % GEO_ZIPS).alias("id")).distinct()
    zip_code = F.lit(ZIP_BASE) + F.col("id")
    amount = F.lit(INCOME_BASE) + (F.col("id") * INCOME_MULT) % INCOME_SPAN
    return nth.select(
        F.when(zip_code % 9 != 0, zip_code.cast("string")).alias("Zip Code"),
        F.concat(F.lit("$"), F.format_number(amount, 0)).alias("Estimated Median Income"),
    )


GEO_SQL = f"""geo AS (
  SELECT CASE WHEN c_custkey % 89 <> 0 THEN {lat_sql('c_custkey')} END AS lat, {place_lon_sql('c_custkey')} AS lon,
         CAST({ZIP_BASE} + c_custkey % {GEO_ZIPS} AS VARCHAR) AS zip
  FROM (SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 97 = 0)
  WHERE c_custkey % 10 <> 7)"""

INC_SQL = f"""inc AS (
  SELECT CAST({ZIP_BASE} + id AS VARCHAR) AS zip,
         CAST(regexp_replace('$' || format('{{:,}}', {INCOME_BASE} + (id * {INCOME_MULT}) % {INCOME_SPAN}),
                             '[$,]', '', 'g') AS INTEGER) AS income
  FROM (SELECT DISTINCT c_custkey % {GEO_ZIPS} AS id FROM customer) WHERE ({ZIP_BASE} + id) % 9 <> 0)"""


# --------------------------------------------------------------------- facts
# Victim descent of an order: a code by its key, every 20th one unknown.
DESCENTS = [*DESCENT_CODES, "?"]


def order_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as incidents: status = victim descent code by the order key,
    priority ~ victim sex, o_orderdate ~ DATE OCC, the customer's place; the
    latitude of every 53rd order is unknown."""
    o = table(spark, sf_dir, "orders")
    nth = F.pmod("o_orderkey", F.lit(len(DESCENTS))).cast("int")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus").isNotNull(), F.get(F.array(*map(F.lit, DESCENTS)), nth)).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        "o_orderdate",
        F.when(F.col("o_orderkey") % 53 != 0, lat_of("o_custkey")).alias("lat"),
        place_lon("o_custkey").alias("lon"),
    )


def order_facts_sql(extra_where: str = "") -> str:
    where = "o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL"
    if extra_where:
        where += f" AND {extra_where}"
    codes = ", ".join(f"'{c}'" for c in DESCENTS)
    return f"""facts AS (
  SELECT ([{codes}])[1 + o_orderkey % {len(DESCENTS)}] AS status,
         CASE WHEN o_orderkey % 53 <> 0 THEN {lat_sql('o_custkey')} END AS lat, {place_lon_sql('o_custkey')} AS lon
  FROM orders WHERE {where})"""


ORDER_FACTS_SQL = order_facts_sql()


def hhmm_col(null_every: int | None = None) -> Column:
    """HHMM time of an event (``hour*100 + minute``); with ``null_every=n``
    the time of every n-th event id is unknown (NULL)."""
    hhmm = F.hour("ts") * 100 + F.minute("ts")
    if null_every:
        hhmm = F.when(F.col("event_id") % null_every == 0, F.lit(None)).otherwise(hhmm)
    return hhmm.cast("int")


def event_incidents(spark: SparkSession, sf_dir: str, null_every: int | None = None) -> DataFrame:
    """events as incidents with an HHMM time."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "event_type", "user_id", "props", hhmm_col(null_every).alias("hhmm"))


def hhmm_sql(null_every: int | None = None) -> str:
    base = "(hour(ts) * 100 + minute(ts))"
    if null_every:
        return f"CASE WHEN event_id % {null_every} = 0 THEN NULL ELSE {base} END"
    return base


def line_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as incidents: area = supplier key, weapon code = quantity,
    coordinates from the order key, null island where l_partkey % 50 = 0."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("AREA "),
        F.col("l_quantity").cast("int").alias("weapon_cd"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(0.0)).otherwise(lat_of("l_orderkey")).alias("LAT"),
        lon_of("l_orderkey").alias("LON"),
    )


LINE_FACTS_SQL = f"""facts AS (
  SELECT l_suppkey AS area,
         CASE WHEN l_partkey % 50 = 0 THEN 0.0::DOUBLE ELSE {lat_sql('l_orderkey')} END AS lat,
         {lon_sql('l_orderkey')} AS lon
  FROM lineitem
  WHERE starts_with(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), '1'))"""


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as police stations: PREC = s_suppkey, X/Y from the key."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("PREC"),
        "s_name",
        "s_nationkey",
        lat_of("s_suppkey").alias("X"),
        lon_of("s_suppkey").alias("Y"),
    )


STATIONS_SQL = f"""stations AS (
  SELECT s_suppkey AS area, s_suppkey, s_name, s_nationkey,
         {lat_sql('s_suppkey')} AS slat, {lon_sql('s_suppkey')} AS slon
  FROM supplier)"""


# ------------------------------------------------------------- CSV exports
ORDERS_CSV_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "date_occ STRING, o_orderpriority STRING"
)
_CSV_CACHE: dict[tuple[str, str, str], list[str]] = {}


def _export_two_files(spark: SparkSession, sf_dir: str, name: str, export: DataFrame, key: str) -> list[str]:
    """Write ``export`` once per application as two CSV files with a header
    each (a partitioned write on ``key % 2``: one job), under the shared
    checkpoint folder; return the two paths."""
    cache_key = (spark.sparkContext.applicationId, sf_dir, name)
    if cache_key not in _CSV_CACHE:
        base = scratch_path(spark, f"{name}-csv")
        write_csv(export.withColumn("file_no", F.col(key) % 2 + 1), base, partition_by=["file_no"])
        _CSV_CACHE[cache_key] = [f"{base}/file_no=1", f"{base}/file_no=2"]
    return _CSV_CACHE[cache_key]


def orders_csv(spark: SparkSession, sf_dir: str) -> list[str]:
    """orders exported as two CSV files, the order date as 12-hour text."""
    o = table(spark, sf_dir, "orders")
    export = o.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.date_format("o_orderdate", INCIDENT_TS_FORMAT).alias("date_occ"),
        "o_orderpriority",
    )
    return _export_two_files(spark, sf_dir, "orders", export, "o_orderkey")


def orders_csv_reordered(spark: SparkSession, sf_dir: str) -> list[str]:
    """The same two halves as :func:`orders_csv` with differing headers: the
    second has another column order and a column of its own."""
    cache_key = (spark.sparkContext.applicationId, sf_dir, "orders-reordered")
    if cache_key not in _CSV_CACHE:
        first, second = (spark.read.option("header", True).csv(p) for p in orders_csv(spark, sf_dir))
        base = scratch_path(spark, "orders-reordered-csv")
        second = second.withColumn("remark", F.lit("none")).select(
            "o_orderpriority", "remark", "o_orderstatus", "date_occ", "o_orderkey", "o_totalprice", "o_custkey")
        write_csv(first, f"{base}/1")
        write_csv(second, f"{base}/2")
        _CSV_CACHE[cache_key] = [f"{base}/1", f"{base}/2"]
    return _CSV_CACHE[cache_key]


# Field positions of the events export (the line-by-line reader uses them).
EVENTS_CSV_FIELDS = ["event_id", "ts", "user_id", "event_type", "value", "TIME OCC"]


def events_csv(spark: SparkSession, sf_dir: str, null_every: int = 37) -> list[str]:
    """events exported as two CSV files; ``TIME OCC`` is the HHMM time,
    empty for every ``null_every``-th event."""
    e = table(spark, sf_dir, "events")
    export = e.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        "user_id",
        "event_type",
        "value",
        hhmm_col(null_every).alias("TIME OCC"),
    )
    return _export_two_files(spark, sf_dir, f"events-null{null_every}", export, "event_id")
