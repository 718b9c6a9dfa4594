"""Links between components of sets that leaders alone do not find, by prefixes.

Sets of 64-bit items are put in one order of all items, rarest first. Two sets of a
Jaccard similarity of ``threshold`` or more share an item among the first few of both:
the first ``size - threshold * size + 1`` of the larger one, and the first ``size -
2 * threshold / (1 + threshold) * size + 1`` of the smaller. So candidates are joined by
such items, and none is lost. What many sets have in common comes late in the order: sets
that share only a passage are no candidates.

Sets of one component are not held against each other. Of the sets with an item, only
those outside the item's commonest component are held against the others, so a large
component with a few sets beside it gives as many comparisons as these have, times its
size, and no more. An item of many sets is dealt out by salts.

The order needs counts of items. They are kept in ``COUNTERS`` counters, to which
items go by their low bits; items that share a counter only make the order worse, not
the result. The counters are all that reaches the driver.

Sets without an item, and an empty table, give no links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.llm.common import cut_lineage, for_once

#: Counters of the order of items (two megabytes), a power of two.
COUNTERS = 1 << 18
#: Rows of one item that meet in one place.
DEAL = 4_096
#: Prefix items that a task gives back in one go.
LOT = 65_536
#: What rounding may do to a product of a threshold and a size.
SLACK = 1e-9

PREFIX = "token long, code long, label long, size int, place int, short boolean"


def counters(sets: DataFrame) -> np.ndarray:
    """How often the items of each counter occur."""
    at = F.col("item").bitwiseAND(F.lit(COUNTERS - 1)).cast("int")
    rows = for_once(sets.select(F.explode("items").alias("item")).groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n"))).toArrow()
    out = np.zeros(COUNTERS, dtype=np.int64)
    out[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return out


def prefix(items: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, int]:
    """The first items that a set must share with any alike set that is not larger, rarest
    first, and how many of them do for one that is not smaller."""
    ranked = items[np.lexsort((items, counts[items & (COUNTERS - 1)]))]
    size = len(items)
    long = size - math.ceil(threshold * size - SLACK) + 1
    return ranked[:long], size - math.ceil(2 * threshold / (1 + threshold) * size - SLACK) + 1


def prefixes(sets: DataFrame, counts: np.ndarray, threshold: float) -> DataFrame:
    """A row for each prefix item of (code, label, items)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            waiting, rows = [], 0
            for code, label, items in zip(batch["code"], batch["label"], batch["items"]):
                first, short = prefix(np.asarray(items, dtype=np.int64), counts, threshold)
                place = np.arange(len(first), dtype=np.int32)
                waiting.append(pd.DataFrame({"token": first, "code": code, "label": label, "size": np.int32(len(items)),
                                             "place": place, "short": place < short}))
                rows += len(first)
                if rows >= LOT:
                    yield pd.concat(waiting)
                    waiting, rows = [], 0
            if waiting:
                yield pd.concat(waiting)
    return sets.select("code", "label", "items").mapInPandas(run, PREFIX)


def candidates(tokens: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a, b) of codes of different labels that may be alike."""
    per = tokens.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy("token").agg(F.count(F.lit(1)).alias("labels"), F.sum("n").alias("rows"),
                                     F.max(F.struct("n", "label")).alias("most")).where(F.col("labels") > 1)
    salts = F.ceil(F.col("rows") / DEAL).cast("int")
    rest = cut_lineage(tokens.join(mixed.select("token", F.col("most.label").alias("main"), salts.alias("salts")), "token"))
    x = rest.where(F.col("label") != F.col("main")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("x")
    y = rest.withColumn("salt", F.pmod("code", "salts").cast("int")).alias("y")

    def either(name: str) -> tuple[Column, Column]:
        return F.col(f"x.{name}"), F.col(f"y.{name}")
    (sx, sy), (px, py), (hx, hy), (a, b) = (either(n) for n in ("size", "place", "short", "code"))
    # What they can still share from here on; at their first common item that is all they share.
    room = 1 + F.least(sx - px, sy - py) - 1
    may = (((sy <= sx) & hy) | ((sx <= sy) & hx)) & (F.least(sx, sy) >= threshold * F.greatest(sx, sy) - SLACK) & (
        room >= threshold / (1 + threshold) * (sx + sy) - SLACK)
    same = (F.col("x.token") == F.col("y.token")) & (F.col("x.salt") == F.col("y.salt"))
    return (x.join(y, same & (F.col("x.label") != F.col("y.label")) & may)
            .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())


def alike(pairs: DataFrame, sets: DataFrame, key: str, threshold: float, give: str) -> DataFrame:
    """(a, b): the columns ``give`` of the pairs (by ``key``) of sets that are alike."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col(key).alias(name), F.col(give).alias(f"_{name}"), F.col("items").alias(f"i{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("ia", "ib"))
    return both.where(shared / (F.size("ia") + F.size("ib") - shared) >= threshold).select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def bridges(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): labels of alike sets, of (node, label, items), that have different labels.

    In the joins sets and labels go by 64-bit hashes of theirs; two nodes with one hash
    are both held against the other side of a pair.
    """
    coded = sets.select(F.xxhash64("node").alias("code"), F.xxhash64("label").alias("label"), "items")
    pairs = cut_lineage(candidates(cut_lineage(prefixes(coded, counters(sets), threshold)), threshold))
    named = sets.select(F.xxhash64("node").alias("code"), "label", "items")
    return alike(pairs, named, "code", threshold, "label").distinct()
