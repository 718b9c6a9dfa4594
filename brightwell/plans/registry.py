"""The query catalogue and the SQL fragments shared by its checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brightwell.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """The tables of one folder, read on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = use_utc(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` with the SQL that must give the same rows."""
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            CHECKS[name] = sql
        return build
    return register


# SQL fragments. They mirror functions.numbers.

def sql_round(value: str, digits: int = 2) -> str:
    # By way of text: the shortest digits of the double, which a cast to DECIMAL would not give.
    return f"CAST(round(CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def sql_money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


def sql_total(value: str) -> str:
    return f"CAST(sum({value}) AS DOUBLE)"


def sql_mean(value: str) -> str:
    return f"(CAST(sum({value}) AS DOUBLE) / NULLIF(count({value}), 0))"


def sql_ratio(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0))"


def sql_percent(part: str, whole: str, digits: int = 1) -> str:
    return sql_round(f"CAST({part} AS DOUBLE) * 100 / NULLIF(CAST({whole} AS DOUBLE), 0)", digits)


def sql_count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


SQL_REVENUE = ("CAST(l_extendedprice AS DECIMAL(12,2)) * "
               "(1 - CAST(l_discount AS DECIMAL(4,2)))")
