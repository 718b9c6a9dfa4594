"""Mixing sources to target weights by hierarchical budgeting.

Weights run down a domain-language-source tree. Each node shares its budget among
its children by weight; a child that cannot use its share (its supply times the
largest number of epochs) keeps what it can, and its siblings take the rest by
weight. Only what all siblings together cannot use has been left with the
parent's own siblings before, because supplies are summed up the tree first.

A leaf takes its budget from an endless row of epochs, each a seeded shuffle of
all its documents: whole epochs first, then the prefix of one more. The document
in which the budget ends is taken, so a leaf is over its budget by less than one
document (rows of one doc_id go together). Budgets are whole tokens and are rounded down, so siblings together
fall short by less than one token each.

The prefix is found without sorting a leaf: the shuffle's keys are hashes, cut
into 4,096 ranges whose tokens are summed; only the range in which a budget ends
is sorted. A tree of up to ``BROADCAST_LEAVES`` leaves is broadcast to the documents;
a larger one is joined by leaf and salt, so that a hot leaf is spread over ``SALTS``
tasks. The result is the same. Null domain, language or source are values of their own. A null text
has no tokens and comes along when its range or epoch is taken. Rows that repeat
count each for itself. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwell.llm.common import cut_lineage, text_bytes

#: Leaves that are broadcast at most, and tasks that a leaf's documents are dealt to beyond.
BROADCAST_LEAVES = 100_000
SALTS = 64
LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """Target weights by level (whole numbers; ``rest`` where none is named), the
    budget as a percentage of the tokens there are, epochs at most, and the seed."""

    domains: dict[str, int] = field(default_factory=dict)
    langs: dict[str, int] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)
    rest: int = 1
    budget_percent: int = 100
    max_epochs: int = 2
    seed: str = "0"


def tokens_of(text: Column) -> Column:
    """A document's size in tokens, at four bytes a token, rounded up."""
    return F.floor((text_bytes(text) + 3) / 4).cast("long")


def domain_of(source: Column) -> Column:
    """The domain of a source: what its name begins with, up to its last digit,
    so that src1 and src10 to src19 are one domain."""
    return F.regexp_extract(source, r"^(.*?[0-9]?)[0-9]?$", 1)


def _weight(column: str, named: dict[str, int], rest: int) -> Column:
    found = F.lit(rest)
    for name, weight in named.items():
        found = F.when(F.col(column) == name, weight).otherwise(found)
    return F.coalesce(found, F.lit(rest)).cast("decimal(38,0)")


def leaves(docs: DataFrame, mix: Mix) -> DataFrame:
    """domain, lang, source, tokens, budget of each leaf."""
    sizes = cut_lineage(docs.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")))
    supply = sizes.agg(F.sum("tokens")).first()[0] or 0
    budget = min(supply * mix.budget_percent // 100, supply * mix.max_epochs)
    tree = sizes.withColumns({"_cap": (F.col("tokens") * mix.max_epochs).cast("decimal(38,0)"),
                              "_budget": F.lit(budget).cast("decimal(38,0)")})
    for depth, (level, named) in enumerate(zip(LEVELS, (mix.domains, mix.langs, mix.sources))):
        tree = _share(tree, list(LEVELS[:depth]), level, _weight(level, named, mix.rest))
    return tree.select(*LEVELS, "tokens", F.col("_budget").cast("long").alias("budget"))


def _share(tree: DataFrame, parent: list[str], level: str, weight: Column) -> DataFrame:
    """Hand ``_budget`` of each parent down to its children of ``level``.

    Children are ordered by supply over weight. Child k takes all it has if its
    fair share of what is left, when all before it have taken all they have, is
    no less; from the first for which it is less on, the rest go by weight.
    """
    children = tree.groupBy(*parent, level).agg(F.sum("_cap").alias("_supply"), F.first("_budget").alias("_over"))
    children = children.withColumn("_weight", weight).withColumn("_need", F.col("_supply").cast("double") / F.col("_weight").cast("double"))
    line = Window.partitionBy(*parent).orderBy("_need", F.col(level).asc_nulls_first())
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(0, Window.unboundedFollowing)
    children = children.withColumns({
        "_left": F.col("_over") - F.coalesce(F.sum("_supply").over(before), F.lit(0)),
        "_shares": F.sum("_weight").over(after)})
    # supply <= left * weight / shares, in whole numbers
    full = F.col("_supply") * F.col("_shares") <= F.col("_left") * F.col("_weight")
    children = children.withColumn("_full", full)
    # Once one is not full, those after it share what was left to that one.
    first = F.min(F.when(~F.col("_full"), F.struct(
        "_need", F.col(level).isNotNull().alias("_known"), level, "_left", "_shares"))).over(Window.partitionBy(*parent))
    children = children.withColumn("_first", first)
    given = F.when(F.col("_full"), F.col("_supply")).otherwise(
        F.floor(F.col("_first._left") * F.col("_weight") / F.col("_first._shares")))
    children = children.select(*[F.col(c).alias(f"_{c}") for c in (*parent, level)],
                               given.cast("decimal(38,0)").alias("_given"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*parent, level)]
    return tree.join(children, same).withColumn("_budget", F.col("_given")).drop(
        "_given", *[f"_{c}" for c in (*parent, level)])


def _with_leaves(docs: DataFrame, known: DataFrame, names: list[str], many: bool, how: str = "inner") -> DataFrame:
    """``docs`` with the row that ``known`` has for their leaf in columns ``names``."""
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(LEVELS, names)]
    if not many:
        return docs.join(F.broadcast(known), same, how)
    salted = docs.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "tokens"), F.lit(SALTS)).cast("int"))
    each = known.withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(each, [*same, F.col("_salt") == F.col("_to")], how).drop("_salt", "_to")


def mixed(docs: DataFrame, mix: Mix, domain: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that make up the mix, once per epoch they are taken in,
    with columns epoch (from 1), budget of the leaf, and domain and tokens."""
    docs = docs.drop("epoch", "budget", "domain", "tokens")
    # The row travels as one column, so that no name of its own can clash.
    sized = docs.select(
        "doc_id", "lang", "source", (domain_of(F.col("source")) if domain is None else domain).alias("domain"),
        tokens_of(F.col("text")).alias("tokens"), F.struct("*").alias("_row"))
    plan = leaves(sized.select(*LEVELS, "tokens"), mix)
    share = plan.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "budget",
                        F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 0 END").alias("_whole"),
                        F.expr("CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END").alias("_part"))
    share = cut_lineage(share)
    many = share.count() > BROADCAST_LEAVES
    # The order of the epoch after the whole ones, in 4,096 ranges.
    order = F.md5(F.concat_ws(":", F.lit(mix.seed), (F.col("_whole") + 1).cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    placed = _with_leaves(sized, share, [f"_{c}" for c in LEVELS], many).withColumn("_order", order).withColumn("_range", F.substring("_order", 1, 3))
    sums = placed.where(F.col("_part") > 0).groupBy(*LEVELS, "_range").agg(
        F.sum("tokens").alias("_sum"), F.first("_part").alias("_goal"))
    running = Window.partitionBy(*LEVELS).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(running), F.lit(0)))
    # The range in which each leaf's budget ends: at most one per leaf.
    ends = ranges.where((F.col("_before") < F.col("_goal")) & (F.col("_before") + F.col("_sum") >= F.col("_goal")))
    ends = cut_lineage(ends.select(*[F.col(c).alias(f"_e{c}") for c in LEVELS], F.col("_range").alias("_end"), "_before"))
    placed = _with_leaves(placed, ends, [f"_e{c}" for c in LEVELS], many, "left")
    edge = placed.where(F.col("_range") == F.col("_end"))
    # Narrow rows of the last ranges, to find the order at which each leaf stops.
    last = Window.partitionBy(*LEVELS).orderBy("_order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    stops = (edge.select(*LEVELS, "_order", "tokens", "_before", "_part")
             .groupBy(*LEVELS, "_order", "_before", "_part").agg(F.sum("tokens").alias("tokens"))
             .withColumn("_reached", F.col("_before") + F.sum("tokens").over(last))
             .where(F.col("_reached") >= F.col("_part")).groupBy(*LEVELS).agg(F.min("_order").alias("_stop")))
    stops = cut_lineage(stops.select(*[F.col(c).alias(f"_s{c}") for c in LEVELS], "_stop"))
    placed = _with_leaves(placed, stops, [f"_s{c}" for c in LEVELS], many, "left")
    times = F.col("_whole") + F.coalesce((F.col("_order") <= F.col("_stop")).cast("long"), F.lit(0))
    taken = placed.withColumn("_times", times).where(F.col("_times") > 0)
    return taken.select("_row.*", "domain", "tokens", "budget",
                        F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("epoch"))


def mixture(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each epoch."""
    rows = docs.select("doc_id", "text", "lang", "source", F.struct("*").alias("_whole_row"))
    return mixed(rows, mix).select("_whole_row.*")
