"""SimHash near-duplicates found by deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments. Two fingerprints that
differ in at most two bits have a segment that differs in at most one, so they
agree in one of the 64 variants made by wiping one bit of one segment. Distinct
fingerprints are indexed by these variants, joined on equality and verified.

A bucket may hold a whole family of near copies. Buckets above ``BUCKET`` members
are not paired: their fingerprints are indexed by themselves and by all 64
one-bit flips. Two fingerprints differ in at most two bits exactly if they share
such a key, and all that share one are links of its smallest member, so a bucket
of n gives n - 1 links and none is lost.

Null text and text without a word have fingerprint zero and link like any other.
Repeated rows and equal texts share a fingerprint and so a component. A null
doc_id is never the smallest; a component with no other has a null id. Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.llm.common import cut_lineage, exploded
from brightwell.llm.components import components, one_of_each, row_keys

BUCKET = 64
SHINGLE = 3
SEED = 42


def simhash(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is 1 if set in over half of the shingle hashes."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, and blanks are ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - width + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:count].tolist(), last.tolist())),
                         dtype="<u8", count=count)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, 65_536):
        bits = np.unpackbits(hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > count).tolist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print): the fingerprint of each whole text, as a signed 64-bit number.
    Columns besides doc_id and text stay."""
    rest = [f for f in docs.schema if f.name not in ("doc_id", "text")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.array([simhash(t) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "print": prints.view(np.int64),
                                **{f.name: batch[f.name] for f in rest}})
    types = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rest)
    return docs.mapInPandas(run, f"doc_id long, print long{types}")


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct ``print`` values within two bits of
    each other. Every link is within two bits; in large buckets some pairs are
    connected through a third."""
    bit, fp = F.col("bit"), F.col("print")
    wiped = F.shiftrightunsigned(fp, 32)
    segment = F.when(bit < 32, fp).otherwise(wiped).bitwiseAND(F.lit(0xFFFFFFFF))
    place = F.expr("shiftleft(1L, bit % 32)")
    key = F.shiftleft(segment.bitwiseAND(F.bitwise_not(place)), 6) + bit
    # Dealt out anew: the few fingerprints of a task become 64 times as many rows.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = prints.repartition(parts, "print").select("print", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")).select("print", key.alias("key"))
    sizes = variants.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = cut_lineage(variants.join(exploded(sizes), "key"))

    few = shared.where(F.col("n") <= bucket).select("key", "print")
    pairs = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.print") < F.col("y.print")) & (
        F.bit_count(F.col("x.print").bitwiseXOR(F.col("y.print"))) <= 2))
    pairs = pairs.select(F.col("x.print").alias("a"), F.col("y.print").alias("b"))

    many = shared.where(F.col("n") > bucket).select("print").distinct()
    flips = many.select("print", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit")).select(
        "print", F.when(F.col("bit") < 0, fp).otherwise(fp.bitwiseXOR(F.expr("shiftleft(1L, greatest(bit, 0))"))).alias("flip"))
    first = flips.groupBy(F.col("flip").alias("to")).agg(F.min("print").alias("first"))
    stars = flips.join(exploded(first), F.col("flip") == F.col("to")).where(F.col("print") != F.col("first")).select("first", "print")
    return pairs.union(stars).distinct()


def _labelled(prints: DataFrame, bucket: int) -> DataFrame:
    """(print, first, label): its smallest doc_id and the component of each fingerprint."""
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("first"))
    labels = components(links(nodes.select("print"), bucket))
    return nodes.join(labels, F.col("print") == F.col("id"), "left").select(
        F.col("print").alias("_print"), "first", F.coalesce("component", "print").alias("label"))


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, print, component_id), one row per input row: component_id is the
    smallest doc_id reachable through links of two or fewer differing bits."""
    prints = cut_lineage(fingerprints(docs.select("doc_id", "text")))
    named = _labelled(prints, bucket)
    lowest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    known = named.join(lowest, "label").select("_print", "component_id")
    return prints.join(known, F.col("print") == F.col("_print")).select("doc_id", "print", "component_id")


def grouped(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, _first, _second, label), a row for each of ``docs``: its component."""
    prints = cut_lineage(fingerprints(row_keys(docs)))
    named = _labelled(prints, bucket).select("_print", "label")
    return prints.join(named, F.col("print") == F.col("_print")).select("doc_id", "_first", "_second", "label")


def keep_one(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Of each component of near-duplicates one row, with the columns of ``docs``.

    The row with the smallest doc_id stays; rows without one lose to rows with one,
    and of several the smallest in column order stays. Components are told apart by
    their fingerprints, so ids may be null or repeat.
    """
    return one_of_each(docs, grouped(docs, bucket))
