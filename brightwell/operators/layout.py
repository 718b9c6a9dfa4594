"""Partition layout, caching and plan inspection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.functions.numbers import ratio


def spread(df: DataFrame, partitions: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Full shuffle into even partitions, or by key."""
    if partitions is None:
        return df.repartition(*keys)
    return df.repartition(partitions, *keys)


def narrow(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions without a shuffle. One partition means one task: keep
    it for results known to be small."""
    return df.coalesce(partitions)


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition."""
    return (df.groupBy(F.spark_partition_id().alias("partition_id"))
            .agg(F.count(F.lit(1)).alias("count")))


def skew_report(df: DataFrame, partitions: int, limit: float = 2.0) -> DataFrame:
    """Largest, smallest and mean partition, and the ratio of largest to smallest.
    ``partitions`` is the number the frame has, so that empty ones count."""
    return partition_rows(df).agg(
        F.lit(partitions).alias("partitions"),
        (F.lit(partitions) - F.count(F.lit(1))).alias("empty_partitions"),
        F.coalesce(F.max("count"), F.lit(0)).alias("max_rows"),
        F.when(F.count(F.lit(1)) < partitions, 0).otherwise(F.min("count")).alias("min_rows"),
        ratio(F.sum("count"), F.lit(partitions)).alias("mean_rows"),
    ).withColumns({
        "skew_ratio": ratio("max_rows", "min_rows"),
        "is_skewed": F.col("max_rows") > F.col("min_rows") * limit})


def key_cardinality(df: DataFrame, *keys: str) -> DataFrame:
    """How often each candidate bucket key occurs."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


@contextmanager
def cached(df: DataFrame, level: StorageLevel | None = None) -> Iterator[DataFrame]:
    """Keep ``df`` for several actions and always release it.

    Cache after filters and column selection. Without a level Spark keeps it
    in memory and spills to disk.
    """
    held = df if df.is_cached else (df.cache() if level is None else df.persist(level))
    try:
        yield held
    finally:
        held.unpersist()


def cache_status(df: DataFrame) -> dict[str, object]:
    level = df.storageLevel
    return {"is_cached": df.is_cached, "use_memory": level.useMemory, "use_disk": level.useDisk}


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text, for logs and tests."""
    return df._explain_string(mode=mode) if hasattr(df, "_explain_string") else \
        df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
