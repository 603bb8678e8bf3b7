"""Incremental forms of the library's operators on Structured Streaming.

The original has no streaming queries; the one job that is naturally
incremental is the folder conversion (CSV files arriving in a folder become
Parquet), so that is what lives here.  Every batch operator in
``blotter.operators`` takes and returns DataFrames and also works on a
streaming DataFrame where Spark allows the operation.
"""

from blotter.streaming.convert import convert_csv_folder

__all__ = ["convert_csv_folder"]
