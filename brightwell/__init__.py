"""Reusable Spark jobs for tables and streams.

Every job takes DataFrames and returns a DataFrame, so the same code runs on a
batch table, on a stream, on a laptop and on a cluster.
"""

__version__ = "0.1.0"
