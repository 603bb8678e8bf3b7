"""CSV scans that keep what does not fit the schema, with the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from blotter.sources.files import _by_header, _in_header_order, _paths, union_files

RAW, REASONS = "_raw", "_reasons"


def read_csv_ledger(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, header: bool = True, sep: str = ",", glob: str | None = None,
) -> DataFrame:
    """Every row of the files: the declared columns, ``_reasons`` and ``_raw``.

    ``_reasons`` is empty for a clean row.  Otherwise it says for each column
    that does not fit ``<column>: <text> is no <type>``, or ``<column>: missing``
    for an empty field of a column declared NOT NULL; and ``fields: malformed
    record`` for a line with too few or too many fields, whose text is ``_raw``.
    Columns that do not fit are NULL.  Columns are bound by header name as in
    :func:`read_csv`, by position without a header.  One scan, no Python.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    reader = spark.read.option("header", header).option("sep", sep).option("columnNameOfCorruptRecord", RAW)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = _by_header(spark, _paths(paths), sep, glob) if header else {}
    scans = found or {tuple(schema.names): []}
    frames = []
    for names, files in scans.items():
        bound, columns = _in_header_order(schema, names, files[0] if files else str(paths))
        texts = StructType([StructField(n, StringType()) for n in bound.names] + [StructField(RAW, StringType())])
        scan = reader.schema(texts).option("enforceSchema", not header or not found).csv(_paths(paths))
        if len(scans) > 1:
            scan = scan.filter(F.col("_metadata.file_path").isin(files))
        frames.append(scan.select(*columns, RAW))
    rows = union_files(frames)
    reasons = [F.when(F.col(RAW).isNotNull(), F.lit("fields: malformed record"))]
    typed = []
    for field in schema.fields:
        text, kind = F.col(f"`{field.name}`"), field.dataType
        value = text if isinstance(kind, StringType) else text.try_cast(kind)
        typed.append(value.alias(field.name))
        sound = F.col(RAW).isNull()
        if not isinstance(kind, StringType):
            reasons.append(F.when(sound & text.isNotNull() & value.isNull(), F.concat(
                F.lit(f"{field.name}: "), text, F.lit(f" is no {kind.simpleString()}"))))
        if not field.nullable:
            reasons.append(F.when(sound & text.isNull(), F.lit(f"{field.name}: missing")))
    return rows.select(*typed, F.array_compact(F.array(*reasons)).alias(REASONS), RAW)


def quarantine(ledger: DataFrame, path: str, mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """Write a ledger once, clean and rejected rows apart, and return
    ``(clean, rejects)`` read back: the clean rows' declared columns, and the
    rejects with their reasons.  Together they are all rows of the input."""
    columns = [c for c in ledger.columns if c not in (REASONS, RAW)]
    parted = ledger.withColumn("rejected", F.size(REASONS) > 0)
    parted.write.mode(mode).partitionBy("rejected").parquet(path)
    stored = ledger.sparkSession.read.schema(parted.schema).parquet(path)
    return stored.filter(~F.col("rejected")).select(*columns), stored.filter("rejected").select(*columns, REASONS, RAW)
