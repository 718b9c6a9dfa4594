"""File sources. Schemas are explicit; inference is an option to ask for."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
BAD_RECORD_POLICIES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")


def to_schema(schema: str | T.StructType) -> T.StructType:
    """A StructType from DDL text, or the StructType itself."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def describe_schema(schema: str | T.StructType) -> list[tuple[str, str, bool, dict]]:
    """(name, type, nullable, metadata) of every field."""
    return [(f.name, f.dataType.simpleString(), f.nullable, dict(f.metadata))
            for f in to_schema(schema).fields]


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
             null_value: str | None = None, policy: str = "FAILFAST", **options) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the file once more to infer it.

    With DROPMALFORMED every column is parsed, also for a query that needs only
    some: whether a row is dropped must not depend on the query.
    """
    reader = spark.read.option("header", True).option("mode", policy)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    for key, value in options.items():
        reader = reader.option(key, value)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(to_schema(schema))
    rows = reader.csv(path)
    return rows.where(_reads_all(rows.columns)) if policy == "DROPMALFORMED" else rows


def _reads_all(columns: Sequence[str]) -> Column:
    """Always true, but keeps the scan from leaving columns unparsed."""
    return F.xxhash64(*columns) >= F.lit(-(2 ** 63))


class Checked(NamedTuple):
    good: DataFrame
    corrupt: DataFrame


def read_csv_checked(spark: SparkSession, path: str, schema: str | T.StructType, **options) -> Checked:
    """Good rows, and the raw text of bad rows.

    The corrupt-record column must be part of the schema, or bad fields would
    turn into NULL without a trace.
    """
    wide = T.StructType([*to_schema(schema).fields, T.StructField(CORRUPT, T.StringType())])
    rows = read_csv(spark, path, wide, policy="PERMISSIVE",
                    columnNameOfCorruptRecord=CORRUPT, **options)
    # Spark refuses a query that reads the corrupt column alone, such as a count.
    names_all = _reads_all(to_schema(schema).names)
    return Checked(rows.where(F.col(CORRUPT).isNull() & names_all).drop(CORRUPT),
                   rows.where(F.col(CORRUPT).isNotNull() & names_all))


def read_json(spark: SparkSession, path: str, schema: str | T.StructType, **options) -> DataFrame:
    """JSON lines."""
    return spark.read.schema(to_schema(schema)).options(**options).json(path)


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False,
                 name_filter: str | None = None) -> DataFrame:
    """Parquet; ``merge_schema`` unites files written before and after a new column."""
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(*paths)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """No rows, known columns: the stand-in for an input that is not there yet."""
    return spark.createDataFrame([], to_schema(schema))


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both versions of a table; columns one side lacks are NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def number_range(spark: SparkSession, first: int, last: int, partitions: int | None = None) -> DataFrame:
    """``first`` to ``last`` (included) made in parallel, one ``id`` column."""
    return spark.range(first, last + 1, 1, partitions)


def with_range_category(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Value (twice the id) and category (by id modulo 3) of generated rows."""
    key = F.col(id_column)
    return df.withColumns({
        "value": key * 2,
        "category": F.when(key % 3 == 0, "Premium").when(key % 3 == 1, "Standard").otherwise("Basic")})


def adjusted_score(category: str = "category", score: str = "score"):
    """Score weighted by category."""
    return (F.when(F.col(category) == "Premium", F.col(score) * 1.5)
            .when(F.col(category) == "Standard", F.col(score) * 1.2).otherwise(F.col(score)))


def required(schema: str | T.StructType) -> Sequence[str]:
    """Names of the columns that must not be NULL."""
    return [f.name for f in to_schema(schema).fields if not f.nullable]
