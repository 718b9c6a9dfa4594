"""Databases, managed tables, table caches and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def use_database(spark: SparkSession, name: str) -> str:
    """Create the database if needed and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}")
    spark.catalog.setCurrentDatabase(name)
    return spark.catalog.currentDatabase()


def databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_table_sql(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {_quoted(name)}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}")


def properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}")


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int,
                  sort_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Managed Parquet table bucketed (and sorted) by key. Joins and aggregates
    on the bucket key then need no shuffle."""
    # One writer task per bucket: otherwise every task writes a file per bucket.
    writer = (df.repartition(buckets, *keys).write.format("parquet")
              .bucketBy(buckets, *keys))
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.mode(mode).saveAsTable(name)


def save_plain(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.format("parquet").mode(mode).saveAsTable(name)


def save_partitioned(df: DataFrame, name: str, keys: Sequence[str], mode: str = "overwrite") -> None:
    """Managed table in one folder per key value, for partition pruning."""
    df.write.format("parquet").partitionBy(*keys).mode(mode).saveAsTable(name)


def cache_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"CACHE TABLE {_quoted(name)}")


def uncache_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"UNCACHE TABLE IF EXISTS {_quoted(name)}")


def refresh_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"REFRESH TABLE {_quoted(name)}")


def analyze_table(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Collect statistics for the cost-based optimiser."""
    tail = f" FOR COLUMNS {', '.join(_quoted(c) for c in columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {_quoted(name)} COMPUTE STATISTICS{tail}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(name)} CASCADE")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register for SQL text in this session."""
    df.createOrReplaceTempView(name)
    return df


def view_from_sql(spark: SparkSession, name: str, query: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {_quoted(name)} AS {query}")
    return spark.table(name)


def shown_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES").where(~F.col("isTemporary"))
