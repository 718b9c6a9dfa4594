"""Relational database sources."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    """Where and how to connect. The password never appears in ``repr``."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    fetch_size: int = 1000
    batch_size: int = 1000
    isolation: str = "READ_COMMITTED"
    session_init: str | None = None

    def options(self) -> dict[str, str]:
        chosen = {
            "url": self.url, "driver": self.driver, "fetchsize": str(self.fetch_size),
            "batchsize": str(self.batch_size), "isolationLevel": self.isolation}
        for key, value in (("user", self.user), ("password", self.password),
                           ("sessionInitStatement", self.session_init)):
            if value is not None:
                chosen[key] = value
        return chosen


def read_table(spark: SparkSession, connection: Connection, table: str) -> DataFrame:
    """One partition: for small tables. Filters and column lists are pushed down."""
    return spark.read.format("jdbc").options(**connection.options()).option("dbtable", table).load()


def read_query(spark: SparkSession, connection: Connection, query: str) -> DataFrame:
    """The database runs the query; only its result is moved."""
    return spark.read.format("jdbc").options(**connection.options()).option("query", query).load()


def read_ranges(spark: SparkSession, connection: Connection, table: str, column: str,
                lower: int, upper: int, partitions: int) -> DataFrame:
    """Parallel read: one connection per range of ``column``. The bounds only
    place the cuts; rows outside them are read too."""
    return (spark.read.format("jdbc").options(**connection.options()).option("dbtable", table)
            .option("partitionColumn", column).option("lowerBound", str(lower))
            .option("upperBound", str(upper)).option("numPartitions", str(partitions)).load())


def column_bounds(spark: SparkSession, connection: Connection, table: str, column: str) -> tuple[int, int]:
    """Smallest and largest value, computed by the database, for ``read_ranges``."""
    row = read_query(spark, connection, f"SELECT MIN({column}) AS LO, MAX({column}) AS HI FROM {table}").first()
    return int(row[0] or 0), int(row[1] or 0)
