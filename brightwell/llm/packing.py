"""Best-fit packing by minimum bin slack.

Token counts of pieces are whole numbers up to the sequence length, so the whole
corpus is a table of at most ``capacity`` counts. The plan is made on that table:
the longest piece left opens a sequence, a subset-sum bitset over the lengths
left finds the fullest sequence that holds it, and that combination is used as
often as the counts allow, then removed. Each combination uses up at least one
length, so the plan has at most ``capacity`` combinations, whatever the size of
the corpus. Spark then numbers the pieces of each length and looks up their
places.

A null text counts as empty and is packed as its end token alone. Rows that
repeat are packed each for itself. Equal lengths are interchangeable; their order
is that of a hash. An empty table packs nothing.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwell.llm.common import cut_lineage, number_rows

CAPACITY = 1024
END = 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "size int, first long, past long, sequence long, uses int, at int"


def tokenizer(folder: str) -> Callable[[str], np.ndarray]:
    """Ids of whole texts by the vocabulary ``byte_bpe_50k`` in ``folder``.

    The same vocabulary lies there for two libraries. Its ranks are used, as that
    library is four times as fast; only texts in which the other finds a special
    token go to it, so ids are always those of ``byte_bpe_50k.json``.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(spelling): int(rank) for spelling, rank in map(bytes.split, lines)}
    plain = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return plain.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
    return encode


def cut(count: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``count`` ids: one if they fit, else full
    ones after a first that takes what is left over."""
    head = count if count <= capacity else count % capacity or capacity
    return [(0, head)] + [(at, capacity) for at in range(head, count, capacity)]


def pieces(docs: DataFrame, folder: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise (doc_id, text) and cut into pieces: doc_id, piece, start, length, ids_crc32."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(folder)
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encode(text or ""), END).astype("<u4")
                out += [(None if pd.isna(doc) else int(doc), n, at, size, zlib.crc32(ids[at:at + size].tobytes()))
                        for n, (at, size) in enumerate(cut(len(ids), capacity))]
            made = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield made.astype({"doc_id": "Int64", "piece": "int32"})
    return docs.select("doc_id", "text").mapInPandas(run, PIECES)


def fullest(counts: Mapping[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination that holds the longest length left: {length: uses}.

    Subset-sum over a bitset: bit s is set if the lengths so far can add up to s.
    Lengths go from long to short, so of equally full combinations the one found
    keeps the short lengths, which fill gaps best.
    """
    longest = max(counts)
    room = capacity - longest
    limit = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left = min(counts[length] - (length == longest), room // length)
        # Copies in doubling lots reach every number of copies up to ``left``.
        lot = 1
        while left > 0:
            take = min(lot, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & limit
            left -= take
            lot *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (size, first, past, sequence, uses, at).

    Pieces number ``first`` to ``past`` - 1 of a length fill ``uses`` places each of
    the sequences that begin with number ``sequence``, from place ``at`` on.
    """
    left = {size: n for size, n in counts.items() if n > 0}
    given = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        used = fullest(left, capacity)
        times = min(left[size] // uses for size, uses in used.items())
        at = 0
        for size, uses in sorted(used.items(), reverse=True):
            rows.append((size, given[size], given[size] + uses * times, sequence, uses, at))
            given[size] += uses * times
            left[size] -= uses * times
            if not left[size]:
                del left[size]
            at += size * uses
        sequence += times
    return rows


def pack(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (any columns and ``length``)."""
    spark: SparkSession = cuts.sparkSession
    cuts = cuts.drop("sequence_id", "offset")
    # The row travels as one column, so that no name of its own can clash.
    cuts = cut_lineage(cuts.select("length", F.struct("*").alias("_row")))
    counts = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(size < 1 or size > capacity for size in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    rows = plan(counts, capacity)
    places = spark.createDataFrame(rows, PLAN)
    ranked = number_rows(cuts, ["length"], "_rank")
    # The plan has at most ``capacity`` combinations of at most sqrt(2 * capacity) lengths.
    found = ranked.join(F.broadcast(places), (F.col("length") == F.col("size")) & (F.col("_rank") >= F.col("first"))
                        & (F.col("_rank") < F.col("past")))
    step = F.col("_rank") - F.col("first")
    return found.select(
        "_row.*", (F.col("sequence") + F.floor(step / F.col("uses"))).cast("long").alias("sequence_id"),
        (F.col("at") + step % F.col("uses") * F.col("length")).cast("long").alias("offset"))
