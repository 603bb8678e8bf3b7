"""File readers.

One scan over a list of paths replaces "read each file, then union": the
files are split into tasks together, and one schema applies to all of them.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Parquet scan; selecting ``columns`` here keeps ``ReadSchema`` narrow.

    A declared ``schema`` skips the job that reads file footers to infer it
    (and pins the types when files disagree)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*_paths(paths))
    return df.select(*columns) if columns else df


def header_census(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """``file, header``: the first line of every file that has one.

    One distributed pass: every split is a task of its own, which hands on its
    first line and stops; lines of splits that do not begin a file are left out.
    """
    # splits are not packed together in a session whose opening cost fills a partition
    census = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        census.conf.set(f"spark.sql.files.{name}", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    census.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    reader = census.read.option("pathGlobFilter", glob) if glob else census.read
    lines = reader.text(_paths(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.col("value").alias("header"))
    heads = lines.mapInArrow(first, "file string, begin long, header string")
    return heads.filter("begin = 0").select("file", "header")


def _by_header(spark: SparkSession, paths: Sequence[str], sep: str, glob: str | None) -> dict[tuple[str, ...], list[str]]:
    """Files by their header's columns.  One row per file comes to the driver,
    which holds the list of files anyway."""
    found: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(header_census(spark, paths, glob).collect()):
        found.setdefault(tuple(next(csv.reader([row["header"]], delimiter=sep), [])), []).append(row["file"])
    return found


def _in_header_order(schema: StructType, header: Sequence[str], path: str) -> tuple[StructType, list[Column]]:
    """The schema of a file with this header, and the declared columns of it.

    Names match exactly or else but for blanks around them; undeclared
    columns are text, a missing declared one is an error."""
    place = {name.strip(): name for name in header} | {name: name for name in header}
    found = {f.name: place.get(f.name, place.get(f.name.strip())) for f in schema.fields}
    missing = [name for name, at in found.items() if at is None]
    if missing:
        raise ValueError(f"{path}: header lacks declared columns {missing}")
    types = {found[f.name]: f.dataType for f in schema.fields}
    bound = StructType([StructField(name, types.get(name, StringType())) for name in header])
    return bound, [F.col(f"`{found[f.name]}`").alias(f.name) for f in schema.fields]


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    sampling_ratio: float | None = None,
    mode: str = "PERMISSIVE",
    glob: str | None = None,
) -> DataFrame:
    """CSV scan with a header row.

    With ``schema`` (the default path) columns are bound by *name*: each
    file's header line says where a declared column stands, columns that are
    not declared are left out, and a declared one that is missing raises.
    The headers of all files come from one job (:func:`header_census`); files
    with one header are one scan, and several scans are unioned by name.
    Malformed fields become NULL.  Without a header row columns are bound by position.

    With ``schema=None`` types are inferred; pass ``sampling_ratio`` to infer
    from a sample instead of a full extra pass.
    ``mode='DROPMALFORMED'`` drops rows whose fields do not fit the schema -
    but only fields a query reads are parsed, so a bare ``count()`` drops
    nothing; select the columns that must be well-formed first.
    ``glob`` (e.g. ``'*.csv'``) keeps only matching files of a folder, so a
    folder can be read without listing it on the driver first.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is None:
        reader = reader.option("inferSchema", True)
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
        return reader.csv(_paths(paths))
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not header:
        return reader.schema(schema).csv(_paths(paths))
    scans = _by_header(spark, _paths(paths), sep, glob)
    if not scans:  # only empty files
        return reader.schema(schema).csv(_paths(paths))
    frames = []
    for names, files in scans.items():
        bound, columns = _in_header_order(schema, names, files[0])
        scan = reader.option("enforceSchema", False).schema(bound).csv(_paths(paths))
        if len(scans) > 1:
            # a filter on files is applied to the listing: each file is read by one scan
            scan = scan.filter(F.col("_metadata.file_path").isin(files))
        frames.append(scan.select(*columns))
    return union_files(frames)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    fields: Mapping[str, tuple[int, DataType]] | Mapping[str, int],
    sep: str = ",",
    header: bool | str = True,
) -> DataFrame:
    """Read delimited text by field position, without any quoting rules.

    ``fields`` maps an output name to a 0-based index (string result) or to
    ``(index, type)``.  Short lines and unparseable values give NULL instead
    of failing.  ``header=True`` takes the first line of the input as the
    header and drops every line equal to it (each part file may repeat it);
    a string gives the header text directly; ``False`` keeps all lines.

    Prefer :func:`read_csv` for real CSV: a quoted field with a comma shifts
    every later position here.
    """
    lines = spark.read.text(_paths(paths))
    header_text = header if isinstance(header, str) else None
    if header is True:
        # One line, read from one split: a bounded peek, not a collect.
        first = lines.limit(1).collect()
        header_text = first[0]["value"] if first else None
    if header_text is not None:
        lines = lines.filter(F.col("value") != F.lit(header_text))
    # Split each line once; every field then indexes the same array.
    parts = lines.select(F.split(F.col("value"), re.escape(sep), -1).alias("_fields"))
    cols = []
    for name, spec in fields.items():
        index, dtype = (spec, StringType()) if isinstance(spec, int) else spec
        value = F.get(F.col("_fields"), index)
        if not (isinstance(dtype, StringType) or dtype == "string"):
            value = value.try_cast(dtype)
        cols.append(value.alias(name))
    return parts.select(*cols)


def union_files(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union matched by column *name* (positional union silently mixes
    columns when two exports order their headers differently)."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_files needs at least one DataFrame")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames
    )
