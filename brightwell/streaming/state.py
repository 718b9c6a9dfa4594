"""Operators with state of their own: approximate duplicates, sequences that expire.

State is bounded by the keys of two periods, or is one event per key that is
dropped when the watermark has passed its time to live. Spark keeps it in the
state store, so a lost executor is replaced from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brightwell.streaming.combine import with_watermark
from brightwell.streaming.filters import Growing, sift

#: Bits of a filter for each expected key of a period.
BITS_A_KEY = 12


def key_hash(keys: list[str]) -> Column:
    """64-bit hash of a key; a null in one column is not a null in another."""
    return F.xxhash64(*[x for k in keys for x in (F.isnull(k), F.col(k))])


def probably_new(df: DataFrame, keys: list[str], ts: str, keep: str = "1 hour", delay: str = "10 minutes",
                 buckets: int = 256, bits: int = 1 << 13, hashes: int = 1, expected: int | None = None,
                 error: float = 0.01) -> DataFrame:
    """Rows whose key has probably not been seen within ``keep``.

    On a stream each bucket of keys has a chain of Bloom filters (``filters.Growing``)
    for the current and one for the last period of length ``keep``; older ones are
    dropped whole. A repeated key within ``keep`` is never let through (in arrival
    order); a new one is held back with a chance below ``error``, whatever the number
    of keys: a full filter is followed by one of four times its size. State grows with
    the keys of two periods, at some 3 bytes a key; more ``buckets`` make its pieces
    smaller. ``bits`` is the size of a chain's first filter, ``hashes`` the fewest hash
    functions; ``expected`` keys in a period make the first filter large enough for them.

    A table is treated as one batch in the order of time, and exactly: the first row
    of a key in a period stays if the key is not in the period before. That takes an
    aggregate and a join, no filter, so neither many keys nor a hot one cost rows. Rows
    without a time are let through and not remembered. For tables too many or too large
    to be read again see ``operators.known``.
    """
    span = pd.Timedelta(keep)
    if not df.isStreaming:
        return _first_of_periods(df, keys, ts, span.value // 1000)
    if expected is not None:
        bits = max(bits, 1 << (-(-expected * BITS_A_KEY // buckets) - 1).bit_length())
    names = df.columns
    hashed = key_hash(keys)
    marked = with_watermark(df, ts, delay).withColumn("__hash", hashed).withColumn("__bucket", F.pmod(hashed, F.lit(buckets)))

    def chain(counts=(), raw=()) -> Growing:
        return Growing(error / 2, bits, hashes, counts, raw)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        chains: dict[int, Growing] = {}
        if state.exists:
            owners, counts, raw = state.get
            for period in sorted(set(owners)):
                mine = [i for i, p in enumerate(owners) if p == period]
                chains[period] = chain([counts[i] for i in mine], [raw[i] for i in mine])
        for pdf in batches:
            pdf = pdf.sort_values(ts, kind="stable")
            timed = pdf[ts].notna().to_numpy()
            fresh = np.ones(len(pdf), dtype=bool)
            micros = pdf.loc[timed, ts].astype("datetime64[us]").to_numpy().astype(np.int64)
            fresh[timed] = sift(pdf.loc[timed, "__hash"].to_numpy(dtype=np.int64).view(np.uint64),
                                micros // (span.value // 1000), chains, chain)
            yield pdf[fresh][names]
        newest = [(p, n, f.tobytes()) for p in sorted(chains)[-2:] for n, f in zip(chains[p].counts, chains[p].filters)]
        state.update(tuple([row[i] for row in newest] for i in range(3)))

    return marked.groupBy("__bucket").applyInPandasWithState(
        step, df.schema, "periods array<long>, counts array<long>, filters array<binary>", "append", GroupStateTimeout.NoTimeout)


def _first_of_periods(df: DataFrame, keys: list[str], ts: str, micros: int) -> DataFrame:
    """The first row of each key in each period, unless the key is in the period before."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    named = [f"k{i}" for i in range(len(keys))]
    # Nulls last, and the other columns in their order where times are equal.
    order = F.struct(F.col(ts), *[x for n in df.columns if n != ts for x in (F.isnull(n), F.col(n))])
    rows = df.where(F.col(ts).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, named)], ((at - F.pmod(at, F.lit(micros))) / micros).cast("long").alias("period"),
        F.struct(order.alias("order"), F.struct("*").alias("row")).alias("first"))
    firsts = rows.groupBy(*named, "period").agg(F.min("first").alias("first"))
    seen = rows.select(*[F.col(n).alias(f"s{n}") for n in named], (F.col("period") + 1).alias("after")).distinct()
    same = [F.col(n).eqNullSafe(F.col(f"s{n}")) for n in named] + [F.col("period") == F.col("after")]
    return firsts.join(seen, same, "left_anti").select("first.row.*").union(df.where(F.col(ts).isNull()))


def next_within(df: DataFrame, key: str, ts: str, kind: str, first: str, then: str, within: str,
                delay: str = "10 minutes") -> DataFrame:
    """(key, first_ts, next_ts) of each ``first`` event whose next event of the key
    is ``then`` in time, from a stream in event-time order per key.

    State is the last ``first`` event of a key. It lives until the watermark has
    passed ``within`` after it. While it waits, an event that is older is skipped.
    For tables see ``ordered.followed_by``.
    """
    span = pd.Timedelta(within)
    marked = with_watermark(df.select(key, ts, kind), ts, delay)
    types = dict(marked.dtypes)

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_ts, waiting = state.get if state.exists else (None, False)
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values([ts, kind], kind="stable")
        found = []
        for moment, what in zip(rows[ts], rows[kind]):
            now = moment.value // 1000
            if last_ts is not None and now < last_ts:
                continue
            if waiting and what == then and now - last_ts <= span.value // 1000:
                found.append((group[0], pd.Timestamp(last_ts, unit="us"), moment))
            last_ts, waiting = now, what == first
        if waiting:
            state.update((last_ts, waiting))
            state.setTimeoutTimestamp(max(last_ts // 1000 + span.value // 1_000_000, state.getCurrentWatermarkMs()) + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(found, columns=[key, "first_ts", "next_ts"])

    return marked.groupBy(key).applyInPandasWithState(
        step, f"{key} {types[key]}, first_ts {types[ts]}, next_ts {types[ts]}", "last long, waiting boolean", "append",
        GroupStateTimeout.EventTimeTimeout)
