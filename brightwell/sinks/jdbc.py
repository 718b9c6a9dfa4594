"""Relational database sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from brightwell.sources.jdbc import Connection


def write_table(df: DataFrame, connection: Connection, table: str, mode: str = "overwrite",
                truncate: bool = False, column_types: str | None = None,
                table_options: str | None = None, max_connections: int = 16) -> None:
    """Write every partition over its own connection, at most ``max_connections``.

    ``truncate`` keeps the table definition on overwrite.
    """
    writer = (df.write.format("jdbc").options(**connection.options()).option("dbtable", table)
              .option("numPartitions", max_connections).option("truncate", truncate))
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    if table_options:
        writer = writer.option("createTableOptions", table_options)
    writer.mode(mode).save()
