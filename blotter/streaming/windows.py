"""Event-time windows and sessions on streams, with defined late rows.

A stream's watermark is the greatest event time seen before a batch, less the
allowed ``delay``.  A window (or a session, at its last row plus the gap) that
ends at or before the watermark is closed: its result is written once, its state
is dropped, and a row that would only belong to closed windows is *late* and left
out.  Results are appended; a restart from the checkpoint goes on where the last
run stopped, so nothing is lost or written twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _flat(grouped: DataFrame, keys: Sequence[str], results: Sequence[str]) -> DataFrame:
    return grouped.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *keys, *results)


def _named(aggregates: dict[str, Column] | None) -> dict[str, Column]:
    return aggregates or {"n": F.count(F.lit(1))}


def windowed(
    stream: DataFrame, time: str, width: str, slide: str | None, delay: str, keys: Sequence[str] = (),
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """``window_start, window_end``, the ``keys`` and ``aggregates`` (default:
    ``n``) of tumbling windows, or with ``slide`` of sliding ones.  Works alike on
    a batch DataFrame, where no row is late."""
    named = _named(aggregates)
    timed = stream.filter(F.col(time).isNotNull()).withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    window = F.window("_time", width, slide) if slide else F.window("_time", width)
    grouped = timed.groupBy(window.alias("_window"), *keys).agg(*[c.alias(n) for n, c in named.items()])
    return _flat(grouped, keys, list(named))


def sessions(
    stream: DataFrame, time: str, gap: str, delay: str, keys: Sequence[str], aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """Sessions of a key: rows less than ``gap`` apart, in whatever order they
    arrive.  ``window_end`` is the last row's time plus the gap."""
    named = _named(aggregates)
    timed = stream.filter(F.col(time).isNotNull()).withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    grouped = timed.groupBy(F.session_window("_time", gap).alias("_window"), *keys).agg(*[c.alias(n) for n, c in named.items()])
    return _flat(grouped, keys, list(named))


def append_to(results: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append closed windows to Parquet files at ``path``.  ``checkpoint``
    defaults to a folder inside that readers skip; with ``available_now`` the
    query takes what is there, closes what the watermark allows, and stops."""
    writer = results.writeStream.format("parquet").option("path", path).outputMode("append").option(
        "checkpointLocation", checkpoint or f"{path.rstrip('/')}/_windows_checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
