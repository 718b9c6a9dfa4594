"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightwell.session import cut_lineage, for_once, use_utc

__all__ = ["crc_part", "cut_lineage", "exploded", "for_once", "let", "number_rows", "table", "text_bytes", "BLANK", "WORD"]

#: The blanks that part words, and a word, as regular expressions.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once per row.

    A column used inside a lambda is computed again for each element; a lambda's
    own variable is not, so the value is passed through a one-element array.
    """
    return F.transform(F.array(value), then)[0]


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def crc_part(key: Column, parts: int = 4) -> Column:
    """crc32 of the key's text, modulo ``parts``; null keys count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def exploded(other: DataFrame) -> DataFrame:
    """``other``, to be joined to exploded rows: neither side is broadcast.

    Spark sizes exploded rows by the rows before, so it would send a table many times
    the limit for broadcasts through the driver.
    """
    return other.hint("merge")


def number_rows(df: DataFrame, group: Sequence[str], name: str, buckets: int = 1024) -> DataFrame:
    """Number the rows of each group from 0 without a gap, in any group size.

    Equal rows are counted first, so a row repeated a million times is one row in
    the shuffle. Each group is cut into ``buckets`` by a hash of the rows; a
    window numbers one bucket at a time and starts at the count of the buckets
    before it. No task holds a whole group, and a repeated task gives the same
    numbers. ``df`` should be narrow: all its columns move.

    Nulls are values like any other. Empty input gives no rows. A column called
    ``name`` is replaced.
    """
    df = df.drop(name)
    columns = df.columns
    rest = [c for c in columns if c not in group]
    spread = F.pmod(F.xxhash64(*rest), F.lit(buckets)) if rest else F.lit(0).cast("long")
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_bucket", spread)
    keys = [*group, "_bucket"]
    inside = Window.partitionBy(*keys).orderBy(*rest).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counted.groupBy(*keys).agg(F.sum("_copies").alias("_all"))
              .withColumn("_start", F.coalesce(F.sum("_all").over(before), F.lit(0))))
    starts = starts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_start")
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]
    placed = counted.withColumn("_inside", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_copy")
    return (placed.join(starts, same).select(*columns, "_start", "_inside", copies)
            .select(*columns, (F.col("_start") + F.col("_inside") + F.col("_copy")).alias(name)))
