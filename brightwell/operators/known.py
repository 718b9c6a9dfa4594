"""Which keys are known already: Bloom filters of tables, kept as small tables.

A filter is a table (generation, n_blocks, n_hashes, block, bits): each key sets its
bits in one block of 32,768 bits, built by Spark's bitmap aggregates, so that a block
meets its keys in an ordinary join. Filters can be written, read back and merged. New
keys go into a generation of their own, sized by their number and with half the error
of the one before, so a filter grows with its keys, and the errors of all generations
stay below the one asked for. Old generations can be dropped by a ``where``.

Nulls are values of a key like any other. No keys give an empty filter, which knows none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.session import cut_lineage

BLOCK_BITS = 32_768
#: Room beyond the estimated number of keys, and for blocks fuller than others.
SPARE = 1.2


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[x for k in keys for x in (F.isnull(k), F.col(k))])


def _block(key: Column, generation: Column, n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), generation, key), n_blocks)


def _places(key: Column, generation: Column, n_hashes: Column) -> Column:
    """The bits of a key in its block."""
    mixed = F.xxhash64(F.lit(1), generation, key)
    start, step = mixed.bitwiseAND(BLOCK_BITS - 1), F.shiftrightunsigned(mixed, 15).bitwiseAND(BLOCK_BITS - 1)
    third = F.shiftrightunsigned(mixed, 30).bitwiseAND(BLOCK_BITS - 1)
    return F.transform(F.sequence(F.lit(0).cast("long"), n_hashes - 1), lambda i: (start + i * step + i * i * third) % BLOCK_BITS)


def key_filter(df: DataFrame, keys: list[str], error: float = 0.01, generation: int = 0,
               n_keys: int | None = None) -> DataFrame:
    """A filter of the keys of ``df``; written to the checkpoint folder.

    Unless ``n_keys`` gives their number, it is estimated first, from a sketch. Filters
    of one ``generation``, ``error`` and ``n_keys`` can be merged.
    """
    hashed = df.select(_hash(keys).alias("key"))
    if n_keys is None:
        n_keys = hashed.agg(F.approx_count_distinct("key", 0.02)).first()[0]
    n_hashes = math.ceil(math.log2(2 ** (generation + 1) / error))
    n_blocks = max(1, math.ceil(n_keys * SPARE * n_hashes / math.log(2) / BLOCK_BITS))
    shape = [F.lit(generation).alias("generation"), F.lit(n_blocks).cast("long").alias("n_blocks"), F.lit(n_hashes).cast("long").alias("n_hashes")]
    placed = hashed.select(
        *shape, _block(F.col("key"), F.lit(generation), F.lit(n_blocks)).alias("block"),
        F.explode(_places(F.col("key"), F.lit(generation), F.lit(n_hashes).cast("long"))).alias("place"))
    return cut_lineage(placed.groupBy("generation", "n_blocks", "n_hashes", "block").agg(
        F.bitmap_construct_agg("place").alias("bits")))


def merge(one: DataFrame, other: DataFrame) -> DataFrame:
    """One filter of the keys of both. Generations that both have must be of the same
    shape; of another shape they are kept side by side."""
    return one.unionByName(other).groupBy("generation", "n_blocks", "n_hashes", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def unknown(df: DataFrame, keys: list[str], known: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is in no generation of ``known``: none with a known key,
    and all others but a share below the filter's error.

    Distinct keys are looked up, so a hot key meets the filter once.
    """
    # One row for each generation: as many as times that keys were added.
    shapes = known.select("generation", "n_blocks", "n_hashes").distinct().collect()
    if not shapes:
        return df
    if "__key" in df.columns:
        raise ValueError("the column name __key is taken")
    rows = df.withColumn("__key", _hash(keys))
    each = F.array(*[F.struct(F.lit(s["generation"]).alias("generation"), F.lit(s["n_blocks"]).cast("long").alias("n_blocks"),
                              F.lit(s["n_hashes"]).cast("long").alias("n_hashes")) for s in shapes])
    asked = (rows.select("__key").distinct().select("__key", F.explode(each).alias("s")).select("__key", "s.*")
             .withColumn("block", _block(F.col("__key"), F.col("generation"), F.col("n_blocks"))))

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1

    met = asked.join(known, ["generation", "n_blocks", "n_hashes", "block"])
    seen = met.where(F.forall(_places(F.col("__key"), F.col("generation"), F.col("n_hashes")), is_set)).select("__key").distinct()
    return rows.join(seen, "__key", "left_anti").drop("__key")


def extend(known: DataFrame, df: DataFrame, keys: list[str], error: float = 0.01) -> DataFrame:
    """``known`` with the keys of ``df`` it does not have, as a generation of their own."""
    newest = known.agg(F.max("generation")).first()[0]
    return known.unionByName(key_filter(unknown(df.select(*keys), keys, known), keys, error, 0 if newest is None else newest + 1))
