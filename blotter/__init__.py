"""blotter: incident analytics as composable PySpark DataFrame operators.

Layout
------
sources/    readers and writers (CSV, Parquet, delimited text, conversion)
functions/  Column -> Column helpers (dates, HHMM times, currency, codes, distance)
operators/  DataFrame -> DataFrame building blocks (filters, ranking, joins, distance)
plans/      the four analytical questions and their variants, plus oracle SQL
streaming/  incremental (Structured Streaming) forms of the same operators
"""

from blotter.session import build_session, checkpoint_base, partition_conf, scratch_path

__all__ = ["build_session", "checkpoint_base", "partition_conf", "scratch_path"]
