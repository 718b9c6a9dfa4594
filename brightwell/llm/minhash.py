"""Document fingerprints by MinHash.

A text is its set of five-word shingles (the whole word sequence if it is
shorter; words parted by ASCII blanks, A-Z in small letters). Each of ``HASHES``
universal hash functions keeps the smallest value over the set, so two texts
agree in each place with the chance of their Jaccard similarity.

``near_duplicates`` joins signatures by bands and verifies candidates on the
shingle sets themselves. ``successive`` compares every document with its edited
text and with the next document in descending doc_id; it deals documents into
slices of that order and gives each slice the first document of the next, so no
task needs more than its own slice, read as a stream.

Null text counts as empty. All texts without a word share one fingerprint and
are alike. Null ids come last, repeated ids are ordered by a hash of their text.
A single document is its own next. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.llm.bridges import alike, bridges
from brightwell.llm.common import cut_lineage, exploded
from brightwell.llm.components import components, one_of_each, row_keys

HASHES = 64
SHINGLE = 5
SEED = 20_240_601
#: Nodes of one band that are compared pair by pair, and narrower bands for those of larger ones.
BUCKET = 16
NARROW = 32
#: Documents aimed at in a slice of the order, and slices at most.
SLICE = 8_192
SLICES = 8_192
#: Ranges of the text hash that documents without an id are dealt into.
LOOSE = 256
#: Shingles that are hashed in one go.
LOT = 32_768

_EMPTY = np.uint64(0xFFFFFFFF)


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles, repeats included."""
    words = text.encode().lower().split()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))
    count = len(words) - min(width, len(words)) + 1 if words else 0
    total = np.zeros(count, dtype=np.uint64)
    for step in range(min(width, len(words))):
        # A polynomial in an odd number: shingles of the same words in other order differ.
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[step:step + count]
    total ^= total >> np.uint64(32)
    return total * np.uint64(0xD6E8FEB86659FD93)


def functions(hashes: int = HASHES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and shifts of the hash functions x -> (a x + b) / 2^32."""
    draw = np.random.default_rng(seed)
    a = draw.integers(0, 2 ** 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 2 ** 63, hashes, dtype=np.uint64)


def signatures(texts: Sequence[str], hashes: int = HASHES, width: int = SHINGLE) -> np.ndarray:
    """One row of ``hashes`` 32-bit minima per text."""
    a, b = functions(hashes)
    out = np.full((len(texts), hashes), _EMPTY, dtype=np.uint64)
    waiting: list[tuple[int, np.ndarray]] = []
    size = 0

    def settle() -> None:
        x = np.concatenate([s for _, s in waiting])
        starts = np.cumsum([0] + [len(s) for _, s in waiting[:-1]])
        rows = [i for i, _ in waiting]
        for k in range(hashes):
            least = np.minimum.reduceat((x * a[k] + b[k]) >> np.uint64(32), starts)
            out[rows, k] = np.minimum(out[rows, k], least)

    for i, text in enumerate(texts):
        found = shingles(text, width)
        for at in range(0, len(found), LOT):
            part = found[at:at + LOT]
            if waiting and (size + len(part) > LOT or waiting[-1][0] == i):
                settle()
                waiting, size = [], 0
            waiting.append((i, part))
            size += len(part)
    if waiting:
        settle()
    return out.astype(np.uint32)


def written(signature: np.ndarray) -> str:
    """A signature as text, eight hex digits for each place."""
    return signature.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Share of equal places, row by row: an estimate of the Jaccard similarity."""
    return (one == other).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by the beginning of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_order(docs: DataFrame) -> DataFrame:
    """Documents in slices of descending doc_id, each slice with its own end.

    Returns _slice, _end, doc_id, text, one slice sorted within one partition. Rows
    with ``_end`` repeat the first document after the slice (after the last slice:
    the first document of all), and come last in it.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = min(SLICES, max(4 * parts, rows // SLICE))
    cuts = docs.stat.approxQuantile("doc_id", [i / slices for i in range(1, slices)], 0.2 / slices) if rows else []
    cuts = sorted({int(c) for c in cuts})
    edges = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    hashed = F.xxhash64("text")
    ahead = len(cuts) + 1
    # How many cuts are below the id, by halving.
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))]).cast("array<int>")
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(cuts)) & (F.get(edges, at + step - 1) < F.col("doc_id")), at + step).otherwise(at))
    place = F.when(F.col("doc_id").isNull(), F.shiftrightunsigned(hashed, 56) + ahead).otherwise(F.lit(len(cuts)) - below)
    placed = docs.withColumns({"_slice": place.cast("int"), "_hash": F.shiftrightunsigned(hashed, 1)})
    best = F.min(F.struct((-F.col("doc_id")).alias("id"), F.col("_hash").alias("hash"))).alias("first")
    heads = sorted(placed.groupBy("_slice").agg(best).collect(), key=lambda r: r["_slice"])
    ends = [(heads[i]["_slice"], None if after["first"]["id"] is None else -after["first"]["id"], after["first"]["hash"])
            for i, after in enumerate(heads[1:] + heads[:1])]
    # As many rows as slices, SLICES + LOOSE at most.
    known = F.broadcast(spark.createDataFrame(ends, "_to int, _id long, _first long"))
    tails = placed.join(known, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_first"))).select(
        F.col("_to").alias("_slice"), F.lit(True).alias("_end"), "doc_id", "text", "_hash")
    body = placed.select("_slice", F.lit(False).alias("_end"), "doc_id", "text", "_hash")
    return (body.union(tails).repartition("_slice")
            .sortWithinPartitions("_slice", "_end", F.col("doc_id").desc_nulls_last(), "_hash", "text").drop("_hash"))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def successive(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending = None  # (slice, doc_id, text, signature) of the row whose next is still to come
        for batch in batches:
            prints = signatures(batch["text"].tolist())
            rows = list(zip(batch["_slice"], batch["_end"], batch["doc_id"], batch["text"], prints))
            done, nexts = [], []
            for place, end, doc, text, own in rows:
                if pending is not None and pending[0] == place:
                    done.append(pending[1:])
                    nexts.append((text, own))
                pending = None if end else (place, doc, text, own)
            if done:
                yield compared(done, nexts)

    return in_order(docs).mapInPandas(run, RESULT)


def compared(rows: list[tuple], nexts: list[tuple]) -> pd.DataFrame:
    changed = [edited(text, after) for (_, text, _), (after, _) in zip(rows, nexts)]
    own = np.array([r[2] for r in rows])
    others = signatures(changed)
    return pd.DataFrame({
        "doc_id": pd.array([None if pd.isna(r[0]) else int(r[0]) for r in rows], dtype="Int64"),
        "n_chars": [len(r[1]) for r in rows],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [written(s) for s in own], "edited_fingerprint": [written(s) for s in others],
        "near_edited": likeness(own, others), "near_next": likeness(own, np.array([n[1] for n in nexts]))})


def band_count(threshold: float, most_missed: float = 1e-3) -> int:
    """Bands, each of HASHES // bands places, by which a pair at ``threshold`` is missed
    with a chance of ``most_missed`` at most; one for each place if none will do."""
    for bands in (b for b in range(1, HASHES) if HASHES % b == 0):
        if (1 - threshold ** (HASHES // bands)) ** bands <= most_missed:
            return bands
    return HASHES


def _sets(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and items: the sorted distinct shingle hashes of each text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            items = [np.unique(shingles(t or "")).view(np.int64) for t in batch["text"]]
            yield pd.DataFrame({**{k: batch[k] for k in keep}, "items": items})
    types = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInPandas(run, ", ".join(f"{k} {types[k]}" for k in keep) + ", items array<long>")


def _bucketed(keyed: DataFrame, bucket: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of (key, node) rows, and the rows of large buckets.

    All pairs of a bucket of ``bucket`` nodes or fewer; in larger ones each node with
    one leader, which the key picks.
    """
    order = F.xxhash64("key", "node")
    leads = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order.alias("h"), F.col("node"))).alias("lead"))
    leads = leads.where(F.col("n") > 1).select("key", "n", F.col("lead.node").alias("lead"))
    shared = cut_lineage(keyed.join(exploded(leads), "key"))
    few = shared.where(F.col("n") <= bucket).select("key", "node")
    pairs = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    large = shared.where(F.col("n") > bucket)
    stars = large.where(F.col("node") != F.col("lead")).select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b"))
    return pairs.union(stars), large.select("key", "node")


def grouped(docs: DataFrame, threshold: float = 0.8, bands: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, _first, _second, label), a row for each of ``docs``: its group."""
    bands = band_count(threshold) if bands is None else bands
    places = HASHES // bands
    keys = row_keys(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "_first": batch["_first"], "_second": batch["_second"],
                "node": [xxhash.xxh3_128_digest(np.unique(shingles(t)).tobytes()) for t in texts],
                "sign": [s.tobytes() for s in signatures(texts)]})

    made = cut_lineage(keys.mapInPandas(run, "doc_id long, _first long, _second long, node binary, sign binary"))
    nodes = made.groupBy("node").agg(F.min(F.struct("_first", "_second")).alias("row"), F.min("sign").alias("sign"))
    nodes = cut_lineage(nodes.select("node", "row.*", "sign"))

    def keyed(df: DataFrame, groups: Sequence[Sequence[int]]) -> DataFrame:
        found = [F.xxhash64(F.lit(i), *[F.substring("sign", 4 * p + 1, 4) for p in group]) for i, group in enumerate(groups)]
        return df.select("node", F.explode(F.array(*found)).alias("key"))

    pairs, large = _bucketed(keyed(nodes, [range(b * places, (b + 1) * places) for b in range(bands)]), bucket)
    # Nodes of large buckets meet again in narrower ones.
    draw = np.random.default_rng(SEED)
    narrow = [sorted(draw.choice(HASHES, min(HASHES, 2 * places), replace=False).tolist()) for _ in range(NARROW)]
    crowd = large.select("node").distinct()
    more, _ = _bucketed(keyed(nodes.join(crowd, "node", "left_semi"), narrow), bucket)
    pairs = cut_lineage(pairs.union(more).distinct())
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    rows = nodes.join(wanted, "node", "left_semi").select("node", "_first", "_second")
    sets = cut_lineage(_sets(keys.join(rows, ["_first", "_second"]).select("node", "text").dropDuplicates(["node"]), ["node"]))
    labels = components(alike(pairs, sets, "node", threshold, "node"))
    named = cut_lineage(nodes.select("node").join(labels, F.col("node") == F.col("id"), "left")
                        .select("node", F.coalesce("component", "node").alias("label")))
    # Leaders can leave a member out. Large buckets of more than one component are searched again, whole.
    tagged = large.join(named, "node")
    mixed = tagged.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(F.col("low") != F.col("high"))
    unsettled = cut_lineage(tagged.join(mixed.select("key"), "key", "left_semi").select("node", "label").distinct())
    if not unsettled.isEmpty():
        joined = components(bridges(sets.join(unsettled, "node"), threshold))
        named = named.join(joined, F.col("label") == F.col("id"), "left").select("node", F.coalesce("component", "label").alias("label"))
    return made.drop("sign").join(named, "node").select("doc_id", "_first", "_second", "label")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, component_id): the smallest doc_id reachable through pairs of texts
    whose shingle sets have a Jaccard similarity of ``threshold`` or more.

    Texts of the same shingle set are one node. Candidates agree in a band of the
    signature; each is verified on the sets, so no link is wrong. Unless given, the
    bands follow from the threshold: at 0.8 there are 16 of 4 places, and a pair of
    similarity 0.8 is a candidate with a chance of 0.9998.

    A band that more than ``bucket`` nodes share would give pairs by the square of
    its size. There each node is held against one leader, and all nodes of such
    bands are dealt anew by ``NARROW`` bands of twice the places, where a pair of
    similarity 0.8 meets with a chance of about 0.99 (again with one leader in large
    buckets). So candidates grow with the number of nodes. What leaders leave apart in a
    large band is searched by prefixes of the sets (``bridges``), which loses no link.
    """
    found = grouped(docs, threshold, bands, bucket)
    lowest = found.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return found.join(lowest, "label").select("doc_id", "component_id")


def keep_one(docs: DataFrame, threshold: float = 0.8, bands: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """Of each group of ``near_duplicates`` one row, with the columns of ``docs``: that
    of the smallest doc_id (null ones last), and of several the smallest in column order."""
    return one_of_each(docs, grouped(docs, threshold, bands, bucket))
