"""Sources, sinks and schema handling: Parquet, CSV (explicit and inferred
schema), positional text, CSV -> Parquet conversion, unions, renames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from blotter.operators.joins import join_with_strategy
from blotter.operators.naming import trim_column_names
from blotter.plans.standins import ORDERS_CSV_DDL, orders_csv, orders_csv_reordered, table
from blotter.session import scratch_path
from blotter.sources.files import read_csv, read_delimited, union_files
from blotter.sources.sinks import csv_to_parquet, list_tables, write_csv
from blotter.streaming.convert import convert_csv_folder


def key_range_by_status(df: DataFrame) -> DataFrame:
    """``o_orderstatus, n, lo, hi``: one pass, partial aggregates per task."""
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderkey").alias("lo"),
        F.max("o_orderkey").alias("hi"),
    )


def q_scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_range_by_status(table(spark, sf_dir, "orders"))


def q_scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_range_by_status(read_csv(spark, orders_csv(spark, sf_dir), schema=ORDERS_CSV_DDL))


def q_scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_csv(spark, orders_csv(spark, sf_dir), schema=None)
    return key_range_by_status(df.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint")))


def q_scan_text_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_delimited(spark, orders_csv(spark, sf_dir), {"o_orderstatus": (2, StringType())})
    return lines.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def q_union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two export files read separately and unioned by column name."""
    first, second = orders_csv(spark, sf_dir)
    both = union_files(
        [read_csv(spark, first, schema=ORDERS_CSV_DDL), read_csv(spark, second, schema=ORDERS_CSV_DDL)]
    )
    return both.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def q_scan_csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports whose headers differ: other order, one undeclared column."""
    return key_range_by_status(read_csv(spark, orders_csv_reordered(spark, sf_dir), schema=ORDERS_CSV_DDL))


CONVERTED = ["orders", "customer"]


def _export_folder(spark: SparkSession, sf_dir: str, src: str) -> None:
    """A folder as exports leave it: a compressed table, a table in partition
    folders, and a nested file that is no table of the folder."""
    write_csv(table(spark, sf_dir, "orders"), f"{src}/orders.csv", compression="gzip")
    write_csv(table(spark, sf_dir, "customer"), f"{src}/customer.csv", partition_by=["c_mktsegment"])
    write_csv(table(spark, sf_dir, "region"), f"{src}/archive/region.csv")


def _declared(spark: SparkSession, sf_dir: str, name: str):
    """Types of the columns in a table's files (partition folders hold one)."""
    found = table(spark, sf_dir, name).schema
    return StructType([f for f in found.fields if f.name != "c_mktsegment"])


def q_csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export two tables as CSV into one folder, convert the folder."""
    src, dst = scratch_path(spark, "csv-in"), scratch_path(spark, "parquet-out")
    _export_folder(spark, sf_dir, src)
    # the folder's tables are discovered, not named; types stay declared
    found = list_tables(spark, src)
    return csv_to_parquet(spark, src, dst, {name: _declared(spark, sf_dir, name) for name in found})


def q_csv_to_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder converted twice; the second conversion replaces the first."""
    src, dst = scratch_path(spark, "csv-in"), scratch_path(spark, "parquet-out")
    _export_folder(spark, sf_dir, src)
    tables = {name: _declared(spark, sf_dir, name) for name in CONVERTED}
    csv_to_parquet(spark, src, dst, tables)
    return csv_to_parquet(spark, src, dst, tables, mode="overwrite")


def q_csv_to_parquet_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversion as a file stream run to completion, twice: the second
    half of each table arrives between the runs."""
    src, dst = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    readbacks = []
    for name in CONVERTED:
        t = table(spark, sf_dir, name)
        late = F.col(t.columns[0]) % 2 == 0
        for rows in (t.filter(~late), t.filter(late)):
            write_csv(rows, f"{src}/{name}.csv", mode="append")
            convert_csv_folder(spark, f"{src}/{name}.csv", f"{dst}/{name}.parquet", t.schema).awaitTermination()
        readbacks.append(
            spark.read.parquet(f"{dst}/{name}.parquet").select(F.lit(name).alias("table_name"))
        )
    return union_files(readbacks).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))


def q_rename_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names with stray blanks (``'c_custkey '``) are trimmed, then
    the frame joins back to customer by the cleaned name."""
    customer = table(spark, sf_dir, "customer")
    messy = customer.select(F.col("c_custkey").alias("c_custkey "), F.col("c_name").alias(" c_name"))
    clean = trim_column_names(messy)
    return clean.join(customer.select("c_custkey"), "c_custkey", "inner").select("c_custkey", "c_name")


def q_select_left_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order columns plus the customer's segment (left join)."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    joined = join_with_strategy(
        orders, customer, orders["o_custkey"] == customer["c_custkey"], "left"
    )
    return joined.select(orders["*"], customer["c_mktsegment"])


_KEY_RANGE_SQL = """SELECT o_orderstatus, COUNT(*) AS n, MIN(o_orderkey) AS lo, MAX(o_orderkey) AS hi
FROM orders GROUP BY 1"""
_STATUS_COUNT_SQL = "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1"
_CONVERTED_SQL = """SELECT 'orders' AS table_name, COUNT(*) AS n FROM orders
UNION ALL SELECT 'customer' AS table_name, COUNT(*) AS n FROM customer"""

QUERIES = {
    "scan_parquet": q_scan_parquet,
    "scan_csv_schema": q_scan_csv_schema,
    "scan_csv_infer": q_scan_csv_infer,
    "scan_csv_reordered": q_scan_csv_reordered,
    "scan_text_delimited": q_scan_text_delimited,
    "union_files": q_union_files,
    "csv_to_parquet": q_csv_to_parquet,
    "csv_to_parquet_overwrite": q_csv_to_parquet_overwrite,
    "csv_to_parquet_stream": q_csv_to_parquet_stream,
    "rename_trim": q_rename_trim,
    "select_left_plus": q_select_left_plus,
}

ORACLE = {
    "scan_parquet": _KEY_RANGE_SQL,
    "scan_csv_schema": _KEY_RANGE_SQL,
    "scan_csv_infer": _KEY_RANGE_SQL,
    "scan_csv_reordered": _KEY_RANGE_SQL,
    "scan_text_delimited": _STATUS_COUNT_SQL,
    "union_files": _STATUS_COUNT_SQL,
    "csv_to_parquet": _CONVERTED_SQL,
    "csv_to_parquet_overwrite": _CONVERTED_SQL,
    "rename_trim": "SELECT c_custkey, c_name FROM customer",
    "csv_to_parquet_stream": _CONVERTED_SQL,
    "select_left_plus": """SELECT o.*, c.c_mktsegment FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
}
