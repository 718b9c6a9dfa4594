"""File sinks for batch results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

WRITE_MODES = ("append", "overwrite", "ignore", "error")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, **options) -> None:
    df.write.mode(mode).option("header", header).options(**options).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = (), **options) -> None:
    """Parquet in as many files as the frame has partitions."""
    df.write.mode(mode).partitionBy(*partition_by).options(**options).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
               max_records_per_file: int | None = None) -> None:
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.json(path)
