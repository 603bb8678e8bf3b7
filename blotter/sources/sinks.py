"""Writers and the CSV -> Parquet converter."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from blotter.sources.files import read_csv, union_files


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Parquet write.  The default mode refuses to overwrite existing output."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    header: bool = True,
    partition_by: Sequence[str] | None = None,
    compression: str | None = None,
) -> None:
    writer = df.write.mode(mode).option("header", header)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def list_tables(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Names of the entries directly under ``folder`` that end in ``suffix``:
    single files, or folders of part files whatever those are called
    (compressed, without a suffix, in partition folders).

    Files are listed by Spark's file index (the ``binaryFile`` source with
    its content column pruned, so no file is read); names are reduced to
    distinct values on the cluster and only those reach the driver.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    top = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    below = F.substring(F.col("path"), len(top) + 2, 1 << 30)
    entry = F.regexp_extract(below, rf"^([^/]+){re.escape(suffix)}(?:/|$)", 1).alias("name")
    return sorted(r["name"] for r in files.select(entry).distinct().collect() if r["name"])


def csv_to_parquet(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    tables: Mapping[str, StructType | None] | Sequence[str] | None = None,
    mode: str = "errorifexists",
    sampling_ratio: float | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Convert ``in_dir/<name>.csv`` to ``out_dir/<name>.parquet`` per table.

    ``tables`` names the inputs (with an explicit schema, or ``None`` to
    infer); without it every ``*.csv`` entry of ``in_dir`` is converted with
    inferred types.  Each conversion is a distributed job of its own, and
    ``at_once`` of them run side by side, so that many small tables do not wait
    for each other; a failure is raised once the running ones are through.  Returns a lazy DataFrame ``(table_name, n)``
    counting the rows read back from the written Parquet.
    """
    if tables is None:
        tables = list_tables(spark, in_dir)
    specs = dict(tables) if isinstance(tables, Mapping) else {t: None for t in tables}

    def convert(item: tuple[str, StructType | None]) -> None:
        name, schema = item
        df = read_csv(spark, f"{in_dir}/{name}.csv", schema=schema, sampling_ratio=sampling_ratio)
        df.write.mode(mode).parquet(f"{out_dir}/{name}.parquet")

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        list(pool.map(inheritable_thread_target(spark)(convert), specs.items()))
    readbacks = [spark.read.parquet(f"{out_dir}/{name}.parquet").select(F.lit(name).alias("table_name")) for name in specs]
    return union_files(readbacks).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
