"""Projections, filters, joins and set operations with the checks big inputs need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str,
           columns: Mapping[str, str], how: str = "left") -> DataFrame:
    """Add ``{output: dimension column}`` by key.

    No hint: Spark broadcasts the dimension if its measured bytes allow it, and
    else joins by a shuffle that adaptive execution can split by skew.
    """
    picked = dimension.select(
        F.col(dimension_key).alias("__key"),
        *[F.col(source).alias(output) for output, source in columns.items()])
    return df.join(picked, df[key] == F.col("__key"), how).drop("__key")


def left_join_defaults(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                       defaults: Mapping[str, Any]) -> DataFrame:
    """Left join that keeps one copy of the key and fills the named gaps."""
    joined = left.join(right, on, "left")
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    return joined.withColumns(filled)


def two_hop(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct (src, dst) pairs two steps apart, the way back left out."""
    steps = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()
    first, second = steps.alias("first"), steps.alias("second")
    return (first.join(second, (F.col("first.dst") == F.col("second.src"))
                       & (F.col("first.src") != F.col("second.dst")))
            .select(F.col("first.src").alias("src"), F.col("second.dst").alias("dst"))
            .distinct())


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``. An aggregate, so a hot key
    is reduced before the shuffle instead of being sorted in one task."""
    rest = [name for name in df.columns if name not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"__best.{name}").alias(name) for name in rest])
            .select(*df.columns))


def find_duplicates(df: DataFrame, keys: Sequence[str], minimum: int = 2) -> DataFrame:
    """Keys that occur at least ``minimum`` times."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") >= minimum))


def metric_rows(df: DataFrame, metrics: Mapping[str, Column],
                name: str = "metric", value: str = "value") -> DataFrame:
    """One (name, value) row per aggregate, all computed in one scan.

    This replaces a UNION ALL with one scan per metric.
    """
    one_row = df.agg(*[expr.alias(f"m{i}") for i, expr in enumerate(metrics.values())])
    pairs = F.array(*[
        F.struct(F.lit(label).alias(name), F.col(f"m{i}").alias(value))
        for i, label in enumerate(metrics)])
    return one_row.select(F.inline(pairs))


def union_all(first: DataFrame, *others: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=allow_missing)
    return result


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION: each side is made distinct before the shuffle of the whole."""
    return union_all(first.distinct(), *[other.distinct() for other in others]).distinct()


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def with_surrogate_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique, not consecutive and not stable between runs."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_random(df: DataFrame, name: str = "score", scale: float = 100.0, seed: int = 42) -> DataFrame:
    """Seeded uniform numbers in [0, scale)."""
    return df.withColumn(name, F.rand(seed) * scale)
