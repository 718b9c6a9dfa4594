"""Link candidates with scores: the pairs without a link that share most neighbours.

Paths over light vertices are joined, at most ``light`` rows for each link. Paths
over hubs are not: every vertex carries the set of hubs it is linked to, and what two
vertices share through hubs is the overlap of their sets. Vertices of equal sets
are one group, so a hub with any number of leaves gives one group of them, not the
square of their number; groups are held against each other only if they can reach
the score of the best pairs known so far.

Of two groups, only pairs of low places (in the order of ids) can be among the best:
all pairs of lower places have the same score and smaller ids. With L links between the
groups a pair of places i, j has i * j - L - 1 or more such pairs without a link before it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.functions.numbers import n_rows
from brightwell.operators.graph import undirected
from brightwell.operators.ordered import row_numbers
from brightwell.session import cut_lineage


def scored_links(edges: DataFrame, k: int = 100, light: int | None = None) -> DataFrame:
    """(a, b, common): the ``k`` pairs a < b without a link that have most common
    neighbours, of equal ones those of the smallest ids. Exact.

    Edges (src, dst) count in both directions and once. Vertices of more than ``light``
    links are hubs; unless given, that is the root of twice the number of links, so
    there are no more hubs than that. Edges with a null end are left out. Distinct sets of hubs may still
    pair by the square of their number where the best score is low.
    """
    links = cut_lineage(undirected(edges.where("src IS NOT NULL AND dst IS NOT NULL")))
    both = cut_lineage(links.select(F.col("a").alias("centre"), F.col("b").alias("v"))
                       .union(links.select(F.col("b").alias("centre"), F.col("a").alias("v"))))
    if light is None:
        light = max(1, math.isqrt(2 * links.count()))
    degrees = cut_lineage(both.groupBy("centre").agg(n_rows().alias("degree")))
    spokes = both.join(degrees.where(F.col("degree") <= light).select("centre"), "centre", "left_semi")
    owned = cut_lineage(both.join(degrees.where(F.col("degree") > light).select("centre"), "centre", "left_semi")
                        .groupBy("v").agg(F.array_sort(F.collect_set("centre")).alias("hubs")))
    near = _best(_over_light(spokes, owned), links, k)

    groups = owned.withColumn("group", F.md5(F.to_json("hubs").cast("binary")))
    members = cut_lineage(row_numbers(groups.select("group", "v"), ["v"], ["group"], name="place"))
    sets = cut_lineage(groups.groupBy("group").agg(F.min("hubs").alias("hubs"), n_rows().alias("n")))
    linked = cut_lineage(_links_of_groups(links, members))

    alike = sets.where("n > 1").select(
        F.col("group").alias("p"), F.col("group").alias("q"), F.col("n").alias("np"), F.col("n").alias("nq"), F.size("hubs").alias("common"))
    known = _best(near.union(_pairs(alike, linked, members, k)), links, k)
    reached = known.agg(n_rows().alias("n"), F.min("common").alias("least")).first()
    least = int(reached["least"]) if reached["n"] >= k else 1
    others = _pairs(_overlaps(sets, least), linked, members, k)
    return _best(known.union(others), links, k)


def _over_light(spokes: DataFrame, owned: DataFrame) -> DataFrame:
    """Pairs with a common light neighbour, and all the neighbours they share."""
    x, y = spokes.alias("x"), spokes.alias("y")
    paths = x.join(y, (F.col("x.centre") == F.col("y.centre")) & (F.col("x.v") < F.col("y.v"))).groupBy(
        F.col("x.v").alias("a"), F.col("y.v").alias("b")).agg(n_rows().alias("n"))
    ends = (paths.join(owned.select(F.col("v").alias("a"), F.col("hubs").alias("ha")), "a", "left")
            .join(owned.select(F.col("v").alias("b"), F.col("hubs").alias("hb")), "b", "left"))
    return ends.select("a", "b", (F.col("n") + F.coalesce(F.size(F.array_intersect("ha", "hb")), F.lit(0))).alias("common"))


def _best(pairs: DataFrame, links: DataFrame, k: int) -> DataFrame:
    """The k best pairs without a link; of a pair that comes twice the higher score."""
    each = pairs.groupBy("a", "b").agg(F.max("common").cast("long").alias("common")).join(links, ["a", "b"], "left_anti")
    return cut_lineage(each.orderBy(F.col("common").desc(), "a", "b").limit(k))


def _links_of_groups(links: DataFrame, members: DataFrame) -> DataFrame:
    """(p, q, linked): links between the members of two groups, p not after q."""
    named = (links.join(members.select(F.col("v").alias("a"), F.col("group").alias("ga")), "a")
             .join(members.select(F.col("v").alias("b"), F.col("group").alias("gb")), "b"))
    return named.groupBy(F.least("ga", "gb").alias("p"), F.greatest("ga", "gb").alias("q")).agg(n_rows().alias("linked"))


def _overlaps(sets: DataFrame, least: int) -> DataFrame:
    """Pairs of different groups that share ``least`` hubs or more.

    Two such sets of s hubs must meet in the s - least + 1 hubs that fewest groups have.
    """
    each = sets.where(F.size("hubs") >= least).select("group", F.explode("hubs").alias("hub"))
    spread = each.groupBy("hub").agg(n_rows().alias("held"))
    ranked = each.join(spread, "hub").groupBy("group").agg(F.array_sort(F.collect_list(F.struct("held", "hub"))).alias("hubs"))
    rare = cut_lineage(ranked.select("group", F.explode(F.slice("hubs", 1, F.size("hubs") - (least - 1))).alias("h")).select("group", "h.hub"))
    pairs = rare.alias("x").join(rare.alias("y"), (F.col("x.hub") == F.col("y.hub")) & (F.col("x.group") < F.col("y.group"))).select(
        F.col("x.group").alias("p"), F.col("y.group").alias("q")).distinct()
    met = (pairs.join(sets.select(F.col("group").alias("p"), F.col("hubs").alias("hp"), F.col("n").alias("np")), "p")
           .join(sets.select(F.col("group").alias("q"), F.col("hubs").alias("hq"), F.col("n").alias("nq")), "q"))
    return met.withColumn("common", F.size(F.array_intersect("hp", "hq"))).where(F.col("common") >= least).select("p", "q", "np", "nq", "common")


def _pairs(groups: DataFrame, linked: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Pairs of members that can be among the k best of their groups p and q."""
    room = F.lit(k) + F.coalesce("linked", F.lit(0))
    same = F.col("p") == F.col("q")
    # Within one group the order of a pair is free, so up to half of i * j counts.
    sized = groups.join(linked, ["p", "q"], "left").withColumn("room", F.when(same, 2 * room).otherwise(room))

    def up_to(first: Column, last: Column) -> Column:
        return F.when(last >= first, F.sequence(first, last))

    one = F.lit(1).cast("long")
    rows = sized.withColumn("i", F.explode(up_to(one, F.least("np", "room"))))
    start = F.when(same, F.col("i") + 1).otherwise(one)
    places = rows.withColumn("j", F.explode(up_to(start, F.least(F.col("nq"), F.expr("room div i")))))
    ends = (places.join(members.select(F.col("group").alias("p"), F.col("place").alias("i"), F.col("v").alias("x")), ["p", "i"])
            .join(members.select(F.col("group").alias("q"), F.col("place").alias("j"), F.col("v").alias("y")), ["q", "j"]))
    return ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.col("common").cast("long").alias("common"))
