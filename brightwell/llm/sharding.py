"""Rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number from (key, shard); the record goes to the shard whose
draw, stretched by its weight, is largest. A draw depends on nothing else, so a
new shard only takes records over, a closed shard only gives its own away, and a
changed weight moves only the share it must.

Null keys count as the empty text. Equal keys always share a shard. Long or
empty texts play no part. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.llm.common import let, number_rows, text_bytes

#: Hex digits of the md5 that make a draw: 13 digits are 52 bits, exact in a double.
DRAW_DIGITS = 13


def draw(key: Column, shard: Column) -> Column:
    """Whole number below 2^52 that depends on key and shard alone."""
    digest = F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("long")


def winner(key: Column, weights: Mapping[int, float]) -> Column:
    """The best (score, draw, shard) of a key, as a struct.

    The score is ``-weight / ln(u)`` with u from the draw, so each shard wins in
    proportion to its weight. Ties go to the larger draw, then the larger shard.
    """
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("every shard needs a weight above zero")
    shards = F.array(*[F.struct(F.lit(int(s)).alias("id"), F.lit(float(w)).alias("weight"))
                       for s, w in sorted(weights.items())])

    def scored(name: Column) -> Column:
        def one(shard: Column) -> Column:
            return let(draw(name, shard["id"]), lambda d: F.struct(
                (-shard["weight"] / F.log((d + F.lit(0.5)) / F.lit(float(16 ** DRAW_DIGITS)))).alias("score"),
                d.alias("draw"), shard["id"].alias("shard")))
        return F.array_max(F.transform(shards, one))
    return let(F.coalesce(key.cast("string"), F.lit("")), scored)


def assign(df: DataFrame, key: Column, weights: Mapping[int, float], name: str = "shard") -> DataFrame:
    """Add each record's shard; a column of that name is replaced. Needs no shuffle."""
    return df.withColumn(name, winner(key, weights)["shard"])


def place(df: DataFrame, shards: int) -> DataFrame:
    """Put documents into ``shards`` equal shards and number each shard's rows.

    Returns doc_id, size (UTF-8 bytes + 8), text_crc32 (null text: empty), law,
    shard, slot (from 0 without a gap) and grown_shard, the shard if there were
    one more. Rows equal in all of these are interchangeable and get slots of
    their own.
    """
    equal = {i: 1.0 for i in range(shards)}
    chosen = df.select(
        "doc_id", (text_bytes(F.col("text")) + 8).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        let(winner(F.col("doc_id"), equal), lambda best: F.struct(
            best["shard"].alias("now"),
            F.greatest(best, winner(F.col("doc_id"), {shards: 1.0}))["shard"].alias("grown"))).alias("_to"))
    rows = chosen.select("doc_id", "size", "text_crc32", F.col("_to.now").alias("shard"),
                         F.col("_to.grown").alias("grown_shard"))
    return number_rows(rows, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
