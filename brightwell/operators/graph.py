"""Property graphs as two DataFrames: vertices(id, ...) and edges(src, dst, ...)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.functions.numbers import ratio
from brightwell.operators.relational import two_hop
from brightwell.session import cut_lineage


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame
    edges: DataFrame

    def __post_init__(self):
        missing = {"id"} - set(self.vertices.columns) | {"src", "dst"} - set(self.edges.columns)
        if missing:
            raise ValueError(f"graph columns missing: {sorted(missing)}")

    def dangling_edges(self) -> DataFrame:
        """Edges with an end that is no vertex."""
        ids = self.vertices.select("id")
        bad_src = self.edges.join(ids, F.col("src") == F.col("id"), "left_anti")
        bad_dst = self.edges.join(ids, F.col("dst") == F.col("id"), "left_anti")
        return bad_src.union(bad_dst).distinct()

    def duplicate_vertices(self) -> DataFrame:
        return self.vertices.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def statistics(graph: Graph) -> DataFrame:
    """Vertices, edges and the mean degree 2E / V."""
    n = F.count(F.lit(1))
    both = (graph.vertices.agg(n.alias("v")).withColumn("e", F.lit(0).cast("long"))
            .unionByName(graph.edges.agg(n.alias("e")).withColumn("v", F.lit(0).cast("long"))))
    return both.agg(F.sum("v").alias("n_vertices"), F.sum("e").alias("n_edges")).withColumn(
        "mean_degree", ratio(F.col("n_edges") * 2, F.col("n_vertices")))


def neighbours(graph: Graph, vertex: str, column: str = "name") -> DataFrame:
    """Vertices an edge leads to from ``vertex``."""
    out = graph.edges.where(F.col("src") == vertex).select("dst").distinct()
    return (graph.vertices.join(out, F.col("id") == F.col("dst"))
            .select("id", column))


def out_degrees(graph: Graph, column: str = "name") -> DataFrame:
    degrees = graph.edges.groupBy("src").agg(F.count(F.lit(1)).alias("count"))
    return graph.vertices.join(degrees, F.col("id") == F.col("src")).select("id", column, "count")


def total_degrees(graph: Graph, column: str = "name") -> DataFrame:
    """In plus out degree. Each end is counted before the union moves it."""
    def side(end):
        return graph.edges.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    degrees = side("src").unionByName(side("dst")).groupBy("id").agg(F.sum("n").alias("degree"))
    return (graph.vertices.join(degrees, "id", "left")
            .select("id", column, F.coalesce("degree", F.lit(0)).cast("long").alias("degree")))


def named_edges(graph: Graph, column: str = "name") -> DataFrame:
    """Edge list with the names of both ends."""
    names = graph.vertices.select("id", column)
    return (graph.edges
            .join(names.select(F.col("id").alias("src"), F.col(column).alias("src_name")), "src")
            .join(names.select(F.col("id").alias("dst"), F.col(column).alias("dst_name")), "dst")
            .select("src_name", "dst_name"))


def link_candidates(graph: Graph, only_new: bool = True) -> DataFrame:
    """Pairs two steps apart; ``only_new`` drops pairs that already have an edge."""
    pairs = two_hop(graph.edges)
    return pairs.join(graph.edges.select("src", "dst"), ["src", "dst"], "left_anti") if only_new else pairs


def undirected(edges: DataFrame) -> DataFrame:
    """Each link once, smaller end first, self-loops dropped."""
    return (edges.where(F.col("src") != F.col("dst"))
            .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct())


def triangle_count(edges: DataFrame) -> DataFrame:
    """Number of triangles of the undirected graph.

    Links point from the end of lower degree to the end of higher degree. No
    vertex then has more than sqrt(2E) links going out, whatever its degree,
    so a hub does not multiply its neighbours. Each candidate is closed by one
    equi-join with the links. The links are read three times for the degrees of
    their ends and so are written once, instead of being made from the edges anew.
    """
    links = cut_lineage(undirected(edges))
    degree = links.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(
        F.count(F.lit(1)).alias("deg"))
    ranked = (links.join(degree.select(F.col("v").alias("a"), F.col("deg").alias("da")), "a")
              .join(degree.select(F.col("v").alias("b"), F.col("deg").alias("db")), "b"))
    forward = F.struct("da", "a") < F.struct(F.col("db").alias("da"), F.col("b").alias("a"))
    pointed = cut_lineage(ranked.select(
        F.when(forward, F.col("a")).otherwise(F.col("b")).alias("lo"),
        F.when(forward, F.col("b")).otherwise(F.col("a")).alias("hi")))
    first, second, third = pointed.alias("x"), pointed.alias("y"), pointed.alias("z")
    paths = first.join(second, F.col("x.hi") == F.col("y.lo")).select(
        F.col("x.lo").alias("p"), F.col("y.hi").alias("q"))
    closed = paths.join(third, (F.col("p") == F.col("z.lo")) & (F.col("q") == F.col("z.hi")))
    return closed.agg(F.count(F.lit(1)).alias("n_triangles"))


def page_rank(graph: Graph, iterations: int = 10, damping: float = 0.85) -> DataFrame:
    """PageRank with a fixed number of rounds; ranks sum to the vertex count.

    Every round is one join and one aggregate. Vertices without an edge out
    give their rank to all. The ranks of a round are read more than once by the
    next, so each round ends in a checkpoint; the links are written once.
    """
    edges = graph.edges.select("src", "dst")
    out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
    links = cut_lineage(edges.join(out, "src"))
    ids = cut_lineage(graph.vertices.select("id").distinct()
                      .join(out.select(F.col("src").alias("id"), F.lit(True).alias("has_out")), "id", "left"))
    n = F.lit(ids.count())
    ranks = ids.withColumn("rank", F.lit(1.0))
    for _ in range(iterations):
        given = (ranks.join(links, F.col("id") == F.col("src"))
                 .groupBy(F.col("dst").alias("to")).agg(F.sum(F.col("rank") / F.col("out")).alias("got")))
        loose = F.coalesce(
            ranks.where(F.col("has_out").isNull()).agg(F.sum("rank")).scalar(), F.lit(0.0))
        ranks = cut_lineage(ids.join(given, F.col("id") == F.col("to"), "left").select(
            "id", "has_out",
            (F.lit(1 - damping) + damping * (F.coalesce("got", F.lit(0.0)) + loose / n)).alias("rank")))
    return ranks.select("id", "rank")


def connected_components(graph: Graph) -> DataFrame:
    """Component of every vertex, named by its smallest id.

    Each round takes the smallest label among the neighbours and then follows
    that label one step (pointer jumping), so long chains shrink quickly.
    Labels are checkpointed each round, which also keeps the plan short.
    """
    links = undirected(graph.edges)
    both = cut_lineage(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                       .union(links.select(F.col("b").alias("u"), F.col("a").alias("v"))))
    labels = cut_lineage(graph.vertices.select("id").distinct().withColumn("component", F.col("id")))
    while True:  # every round but the last lowers a label
        nearest = (both.join(labels, F.col("v") == F.col("id"))
                   .groupBy(F.col("u")).agg(F.min("component").alias("low")))
        lowered = labels.join(nearest, F.col("id") == F.col("u"), "left").select(
            "id", F.col("component").alias("old"),
            F.least(F.col("component"), F.coalesce("low", "component")).alias("component"))
        target = labels.select(F.col("id").alias("t"), F.col("component").alias("t_component"))
        updated = cut_lineage(lowered.join(target, F.col("component") == F.col("t"), "left").select(
            "id", "old", F.least("component", F.coalesce("t_component", "component")).alias("component")))
        labels = updated.select("id", "component")
        if updated.where(F.col("old") != F.col("component")).isEmpty():
            return labels
