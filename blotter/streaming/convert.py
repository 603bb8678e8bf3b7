"""CSV folder -> Parquet, incrementally and exactly once.

A file-stream source lists the folder (optionally through a glob filter),
each trigger picks up only files it has not seen, and the Parquet sink
commits output together with the source offsets in the checkpoint location.
Re-running after a failure or after new files arrive converts exactly the
files not yet converted - no driver-side listing, no "already exists"
errors, no duplicates.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def convert_csv_folder(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    schema: StructType | str,
    checkpoint: str | None = None,
    glob: str | None = "*.csv",
    header: bool = True,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start converting CSV files under ``in_dir`` to Parquet in ``out_dir``.

    A file stream needs an explicit ``schema``, in header order; a file with
    another header fails the query.  ``checkpoint`` defaults to a folder
    inside ``out_dir`` that readers skip, next to the sink's own log: the two
    belong together, so every run continues where the last one stopped.  With ``available_now`` the query processes
    everything present at start (in several batches if
    ``max_files_per_trigger`` is set) and stops; otherwise it keeps watching.
    """
    reader = spark.readStream.schema(schema).option("header", header)
    if header:
        reader = reader.option("enforceSchema", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(in_dir)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint or f"{out_dir.rstrip('/')}/_convert_checkpoint")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
