"""Filters that grow with their keys, on streams and on tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightwell.operators import known
from brightwell.streaming import state
from brightwell.streaming.filters import Growing, sift
from tests.conftest import rows
from tests.test_streaming import collect_stream, events_stream


@pytest.mark.parametrize("n_keys", [300, 5_000, 400_000])
def test_chains_hold_their_error_at_any_number_of_keys(n_keys):
    keys = np.random.default_rng(5).permutation(np.arange(2 * n_keys, dtype=np.uint64))
    inside, outside = keys[:n_keys], keys[n_keys:]
    chain = Growing(0.005, 1 << 13)
    for part in np.array_split(inside, 7):
        chain.add(part[~chain.contains(part)])
    assert chain.contains(inside).all()
    assert chain.contains(outside).mean() < 0.005 + 3 * (0.005 / n_keys) ** 0.5
    again = Growing(0.005, 1 << 13, 1, chain.counts, [f.tobytes() for f in chain.filters])
    assert (again.contains(outside) == chain.contains(outside)).all()
    # Bits grow with the keys: neither squared nor fixed.
    assert sum(len(f) for f in chain.filters) <= max(1024, 10 * n_keys)


def test_sift_agrees_with_sets():
    draw = np.random.default_rng(3)
    values = draw.integers(0, 60, 4000).astype(np.uint64)
    periods = np.sort(draw.integers(0, 40, 4000))
    chains, seen, wanted = {}, {}, []
    for v, p in zip(values.tolist(), periods.tolist()):
        wanted.append(p != seen.get(v) and p - 1 != seen.get(v))
        seen[v] = p
    got = np.concatenate([sift(values[i:i + 700], periods[i:i + 700], chains, lambda: Growing(1e-9, 1 << 13)) for i in range(0, 4000, 700)])
    assert got.tolist() == wanted


def test_streams_grow_without_a_number_of_keys(spark, tmp_path):
    crowd = [[("u", f"10:{m:02d}:{i % 60:02d}", "view", i % 9000) for i in range(m * 3000, m * 3000 + 6000)] for m in range(4)]
    stream = events_stream(spark, tmp_path / "in", *crowd)
    fresh = state.probably_new(stream, ["id"], "ts", keep="1 day", buckets=2, bits=1 << 8)
    got = collect_stream(fresh, "s_grown", "append")
    assert got.count() == got.select("id").distinct().count() and got.count() >= 0.99 * 9000


def test_filters_of_tables(spark):
    ids = spark.range(120_000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).alias("part"), "id")
    base = known.key_filter(ids.where("id < 30000"), ["k"])
    grown = known.extend(base, ids.where("id < 60000"), ["k"])
    # The generation of its own holds the new keys only.
    sizes = {r["generation"]: r["n_blocks"] for r in grown.select("generation", "n_blocks").distinct().collect()}
    assert set(sizes) == {0, 1} and sizes[1] <= 2 * sizes[0]
    left = known.unknown(ids, ["k"], grown)
    assert left.columns == ids.columns and left.where("id < 60000").isEmpty()
    assert 59_400 <= left.count() <= 60_000
    # A repeated increment adds nothing.
    assert known.unknown(ids.where("id < 60000"), ["k"], known.extend(grown, ids.where("id < 60000"), ["k"])).isEmpty()
    forgot = known.unknown(ids.where("id < 30000"), ["k"], grown.where("generation = 1"))
    assert 29_700 <= forgot.count() <= 30_000


def test_merged_filters_know_the_keys_of_both(spark):
    ids = spark.range(20_000)
    halves = [known.key_filter(ids.where(f"id % 2 = {i}"), ["id"], n_keys=20_000) for i in (0, 1)]
    both, whole = known.merge(*halves), known.key_filter(ids, ["id"], n_keys=20_000)
    assert rows(both.withColumn("bits", F.md5("bits")).select(*whole.columns)) == rows(whole.withColumn("bits", F.md5("bits")))
    assert known.unknown(ids, ["id"], both).isEmpty()


def test_filters_of_awkward_keys(spark):
    odd = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("", ""), ("a", "a"), ("a", "a")], "x string, y string")
    filters = known.key_filter(odd.where("x IS NULL AND y = 'a'"), ["x", "y"])
    assert rows(known.unknown(odd, ["x", "y"], filters)) == sorted(
        [("a", None), (None, None), ("", ""), ("a", "a"), ("a", "a")], key=lambda r: [(v is None, str(v)) for v in r])
    empty = known.key_filter(odd.limit(0), ["x", "y"])
    assert known.unknown(odd, ["x", "y"], empty).count() == 6
    assert known.unknown(odd.limit(0), ["x", "y"], filters).isEmpty()
    assert known.unknown(odd.where("x = 'a' AND y = 'a'"), ["x", "y"], known.extend(empty, odd, ["x", "y"])).isEmpty()
    with pytest.raises(ValueError):
        known.unknown(odd.withColumn("__key", F.lit(1)), ["x"], filters)


def test_a_hot_key_meets_the_filter_once(spark):
    hot = spark.range(5000).select(F.lit(7).alias("k"), "id")
    filters = known.key_filter(spark.createDataFrame(pd.DataFrame({"k": [7, 8]})), ["k"])
    assert known.unknown(hot.withColumn("k", F.col("k").cast("long")), ["k"], filters).isEmpty()
    assert known.unknown(hot.select((F.col("k") + 2).cast("long").alias("k"), "id"), ["k"], filters).count() == 5000
