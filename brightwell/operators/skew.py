"""Salting for keys that hold a large share of the rows.

A salt must differ between equal rows and be the same when a task is repeated. A
random number may change, and so may a row's place in its partition if it came
from a shuffle. The salt is therefore a hash of the row and of the number of its
partition: equal rows share one only within a partition, which is no larger than
any task's input. Nothing is written, and hot keys are found by one pass with a
sketch of frequent items.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_salt(df: DataFrame, salts: int, name: str = "__salt") -> DataFrame:
    """Spread rows over ``salts`` numbers, equal rows of different partitions too."""
    # Maps have no hash.
    columns = [F.to_json(c) if kind.startswith("map") else F.col(c) for c, kind in df.dtypes]
    return df.withColumn(name, F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(salts)).cast("int"))


def salted_aggregate(df: DataFrame, keys: Sequence[str], partial: Mapping[str, Column],
                     final: Mapping[str, Column], salts: int = 32) -> DataFrame:
    """Two-phase aggregate: by (keys, salt), then by keys.

    For aggregates whose partial state is large (sets, sketches, sorted lists).
    Plain sums and counts need no salt: Spark already merges them before the shuffle.
    """
    first = with_salt(df, salts).groupBy(*keys, "__salt").agg(*[e.alias(n) for n, e in partial.items()])
    return first.groupBy(*keys).agg(*[e.alias(n) for n, e in final.items()])


#: Least share a key can be asked to hold to count as hot: bounds the hot keys to 10,000.
LEAST_SHARE = 0.0001


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float = 0.01) -> DataFrame:
    """Keys that hold at least ``min_share`` of all rows: at most ``1 / min_share`` of them."""
    if min_share < LEAST_SHARE:
        raise ValueError(f"min_share must be at least {LEAST_SHARE}")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    rows = counts.agg(F.sum("__n")).scalar()
    return counts.where(F.col("__n") >= rows * F.lit(min_share)).select(*keys)


def hot_hashes(df: DataFrame, keys: Sequence[str], min_share: float = 0.01) -> DataFrame:
    """Hashes of keys, among them those of all keys with ``min_share`` of the rows or more:
    ``2 / min_share`` rows at most.

    One pass with a sketch of frequent items, whose counts are off by 3.5 / tracked of the
    rows at most: less than a quarter of the share. A key taken for hot by mistake is only
    spread without need."""
    if not LEAST_SHARE <= min_share <= 1:
        raise ValueError(f"min_share must be from {LEAST_SHARE} to 1")
    most, tracked = math.ceil(2 / min_share), 1 << math.ceil(math.log2(16 / min_share))
    named = df.select(F.xxhash64(*keys).alias("__key"))
    found = named.agg(F.expr(f"approx_top_k(__key, {min(most, tracked)}, {tracked})").alias("items"), F.count(F.lit(1)).alias("n")).first()
    hot = [(r["item"],) for r in found["items"] or [] if r["count"] >= found["n"] * min_share / 2]
    return df.sparkSession.createDataFrame(hot, "__hot long")


def salted_join(large: DataFrame, other: DataFrame, keys: str | Sequence[str], salts: int = 16,
                min_share: float = 0.01, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Equi-join that spreads hot keys of ``large`` over ``salts`` tasks each.

    Only rows of ``other`` with a hot key are copied, once per salt; at most
    ``2 / min_share`` keys are hot, so the marking table is safe to broadcast. ``large``
    is read once for its keys and once for the join; nothing is written.
    ``how`` is inner or left: each row of ``large`` meets each partner once.
    ``null_safe`` lets NULL keys meet; otherwise they match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    keys = [keys] if isinstance(keys, str) else list(keys)
    hot = hot_hashes(large, keys, min_share).withColumn("__is_hot", F.lit(True))

    def marked(df):
        return df.join(F.broadcast(hot), F.xxhash64(*[df[key] for key in keys]) == F.col("__hot"), "left").drop("__hot")
    left = marked(with_salt(large, salts)).withColumn("__salt", F.when(F.col("__is_hot"), F.col("__salt")).otherwise(0)).drop("__is_hot")
    copies = F.when(F.col("__is_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = marked(other).withColumn("__salt", F.explode(copies)).drop("__is_hot")
    right = right.withColumnsRenamed({name: f"__right_{name}" for name in [*keys, "__salt"]})
    match = [left["__salt"] == right["__right___salt"]]
    for key in keys:
        a, b = left[key], right[f"__right_{key}"]
        match.append(a.eqNullSafe(b) if null_safe else a == b)
    return left.join(right, match, how).drop("__salt", *[f"__right_{name}" for name in [*keys, "__salt"]])


def attach(df: DataFrame, by_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a table with one row per key, NULL keys included.

    The small side is dealt out once more by number. Else the join would use the
    partitions of the aggregate it came from, and adaptive execution, which splits
    a hot key of ``df`` over tasks, leaves such joins alone.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    match = [F.col(f"d.{key}").eqNullSafe(F.col(f"t.{key}")) for key in keys]
    added = [F.col(f"t.{name}") for name in by_key.columns if name not in keys]
    return df.alias("d").join(by_key.repartition(parts).alias("t"), match, "left").select("d.*", *added)
