"""Scored link candidates against counting all paths."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from brightwell.operators.candidates import _overlaps, scored_links


def plain(pairs, k):
    links = {(min(p), max(p)) for p in pairs if None not in p and p[0] != p[1]}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    scores = [(a, b, len(near[a] & near[b])) for a, b in itertools.combinations(sorted(near), 2) if (a, b) not in links]
    return sorted((s for s in scores if s[2]), key=lambda s: (-s[2], s[0], s[1]))[:k]


def found(spark, pairs, k, light):
    edges = spark.createDataFrame(sorted(pairs, key=str), "src LONG, dst LONG")
    return [tuple(r) for r in scored_links(edges, k, light).orderBy(F.col("common").desc(), "a", "b").collect()]


@pytest.mark.parametrize(("seed", "k", "light"), [(1, 5, 3), (2, 60, 2), (3, 40, None), (4, 400, 6), (5, 7, 1)])
def test_best_pairs_equal_plain_ones(spark, seed, k, light):
    rng = random.Random(seed)
    # Two hubs with shared leaves, small groups, links among leaves, and a hub linked to a hub.
    pairs = {(0, v) for v in range(10, 40)} | {(1, v) for v in range(25, 50)} | {(0, 1), (5, 5), (None, 3)}
    pairs |= {(rng.randrange(2, 10), rng.randrange(10, 60)) for _ in range(40)}
    pairs |= {(rng.randrange(10, 16), rng.randrange(10, 30)) for _ in range(25)}
    assert found(spark, pairs, k, light) == plain(pairs, k)


def test_linked_low_places_do_not_hide_others(spark):
    # All pairs among the lowest leaves are linked already.
    pairs = {(0, v) for v in range(1, 31)} | set(itertools.combinations(range(1, 9), 2))
    for k in (1, 4, 25):
        assert found(spark, pairs, k, 8) == plain(pairs, k)


def test_a_hub_is_not_squared(spark):
    leaves = 100_000
    star = spark.range(1, leaves + 1).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    few = spark.createDataFrame([(leaves + 7, 3), (leaves + 7, 9)], "src LONG, dst LONG")
    got = [tuple(r) for r in scored_links(star.union(few), 6).orderBy(F.col("common").desc(), "a", "b").collect()]
    assert got == [(0, leaves + 7, 2), (3, 9, 2), (1, 2, 1), (1, 3, 1), (1, 4, 1), (1, 5, 1)]


def test_prefixes_lose_no_overlap(spark):
    rng = random.Random(8)
    made = {str(i): sorted(rng.sample(range(12), rng.randrange(1, 9))) for i in range(40)}
    sets = spark.createDataFrame([(g, h, 1) for g, h in made.items()], "group STRING, hubs ARRAY<LONG>, n LONG")
    for least in (1, 3, 5):
        got = {(r.p, r.q, r.common) for r in _overlaps(sets, least).collect()}
        assert got == {(p, q, len(set(made[p]) & set(made[q]))) for p, q in itertools.combinations(sorted(made), 2)
                       if len(set(made[p]) & set(made[q])) >= least}


def test_graphs_without_candidates(spark):
    assert found(spark, set(), 5, None) == []
    assert found(spark, {(1, 2), (3, 3)}, 5, None) == []
    assert found(spark, {(1, 2), (2, 3), (1, 3)}, 5, 1) == []
