"""Connected components by alternating large-star and small-star steps.

Both steps only re-link a vertex's neighbours to the smallest vertex seen, so the
number of links never grows. The smallest neighbour of each vertex is an
aggregate with partial results on the map side; the join that hands it out has
one row per vertex on one side, so Spark may split a hub's links over tasks.
Links are checkpointed each round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from brightwell.llm.common import cut_lineage, for_once


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every end of a link.

    ``links`` has columns a and b; order, repeats and links of an id to itself do
    not matter, and rows with a null end are no links.
    """
    links = cut_lineage(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    digest = _digest(links)
    while True:
        large = _relink(links.union(links.select(F.col("v"), F.col("u"))), keep_larger=True)
        small = cut_lineage(_relink(large, keep_larger=False))
        before, digest = digest, _digest(small)
        if before == digest:
            break
        links = small
    ends = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.union(links.select("v", "v").distinct())


def _hashes(docs: DataFrame) -> list[Column]:
    values = [*docs.columns, *[F.isnull(c) for c in docs.columns]]
    return [F.xxhash64(*values).alias("_first"), F.xxhash64(F.lit(1), *values).alias("_second")]


def row_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _first, _second): two hashes that stand for the whole row."""
    return docs.select("doc_id", "text", *_hashes(docs))


def one_of_each(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Of each label one row of ``docs``: the smallest doc_id (null ones last), then
    the smallest row in column order. ``labelled`` has (doc_id, _first, _second,
    label), with the hashes of ``row_keys``, for every row."""
    lowest = labelled.groupBy("label").agg(F.min("doc_id").alias("_lowest"))
    best = cut_lineage(labelled.join(lowest, "label").where(F.col("doc_id").eqNullSafe(F.col("_lowest")))
                       .select("label", "_first", "_second"))
    sizes = best.groupBy("label").agg(F.count(F.lit(1)).alias("_rows"), F.min("_first").alias("_first"), F.min("_second").alias("_second"))
    one = sizes.where(F.col("_rows") == 1).select("_first", "_second")
    more = best.join(sizes.where(F.col("_rows") > 1).select("label"), "label", "left_semi").distinct()
    # The row travels as one column, so that no name of its own can clash.
    rows, key = docs.select(F.struct("*").alias("_row"), *_hashes(docs)), ["_first", "_second"]
    alone = rows.join(one, key, "left_semi").select("_row")
    first = rows.join(more, key).groupBy("label").agg(F.min("_row").alias("_row")).select("_row")
    return alone.union(first).select("_row.*")


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two groupings of the same rows as one: rows that share a label in either, or through
    others, get one label. Both have the columns that ``one_of_each`` takes."""
    key = ["_first", "_second"]
    both = one.select(*key, "label").distinct().join(other.select(*key, F.col("label").alias("with")).distinct(), key)
    pairs = cut_lineage(both.select("label", "with").distinct())
    # A label of the other grouping links the labels it holds to the smallest.
    lowest = pairs.groupBy("with").agg(F.min("label").alias("a"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    joined = components(pairs.join(lowest, "with").select("a", F.col("label").alias("b")))
    return one.join(joined, F.col("label") == F.col("id"), "left").select(
        "doc_id", *key, F.coalesce("component", "label").alias("label"))


def _relink(links: DataFrame, keep_larger: bool) -> DataFrame:
    """Link neighbours (u, v) of u to the smallest of u and its neighbours."""
    lowest = links.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("low")).select(
        "w", F.least("w", "low").alias("low"))
    near = links.join(lowest, F.col("u") == F.col("w"))
    if keep_larger:
        moved = near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        moved = near.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            lowest.select(F.col("w").alias("u"), F.col("low").alias("v")))
    return moved.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _digest(links: DataFrame) -> list[Row]:
    """Equal for equal sets of distinct links: their count and summed hashes."""
    return for_once(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))).collect()
