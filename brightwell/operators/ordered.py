"""Window jobs that survive a hot key.

A window function puts every row of one partition key into one task, and a
window without a key puts the whole table there. The jobs here, whatever the
size of the largest key,

1. range-partition the rows by (keys, order), so a hot key spreads over many
   slices and each slice holds one contiguous run;
2. checkpoint once, which fixes the slices even when an executor is lost;
3. run the window inside each slice;
4. add what the earlier slices of the same key contribute. At most one key per
   slice began in an earlier slice, so this carry table has fewer rows than
   there are slices and is safe to broadcast.

``order_by`` must be unique within ``partition_by``; add a key as tie-break.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwell.functions.numbers import percent
from brightwell.operators.skew import attach
from brightwell.session import cut_lineage

_INDEX_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


@dataclass
class Wanted:
    """What to compute, by output name."""

    row_number: str | None = None
    running_sum: Mapping[str, str] = field(default_factory=dict)
    lag: Mapping[str, str] = field(default_factory=dict)
    lead: Mapping[str, str] = field(default_factory=dict)


def ordered_columns(df: DataFrame, order_by: Sequence[Column | str], wanted: Wanted,
                    partition_by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Add the wanted window columns. ``slices`` is the number of shuffle partitions
    unless given."""
    return _sliced(df, list(partition_by), order_by, wanted, slices or _shuffle_partitions(df))


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _window_columns(window, wanted: Wanted) -> dict[str, Column]:
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {}
    if wanted.row_number:
        columns[wanted.row_number] = F.row_number().over(window).cast("long")
    columns |= {name: F.sum(source).over(running) for name, source in wanted.running_sum.items()}
    columns |= {name: F.lag(source).over(window) for name, source in wanted.lag.items()}
    columns |= {name: F.lead(source).over(window) for name, source in wanted.lead.items()}
    return columns


def _sliced(df, keys, order_by, wanted, slices):
    sliced = _slices(df, keys, order_by, slices)
    if not keys and not (wanted.running_sum or wanted.lag or wanted.lead):
        # Only a global number: the row index inside the slice is already it.
        carry = _carry(sliced, keys, wanted)
        index = F.col("__pos").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
        joined = sliced.join(F.broadcast(carry), "__slice", "left")
        return joined.withColumn(
            wanted.row_number, index + 1 + F.coalesce(F.col("__rows_before"), F.lit(0))
        ).drop(*_helpers(carry, keys))
    return _computed(sliced, df.columns, keys, wanted)


def _slices(df, keys, order_by, slices):
    """The rows in order, checkpointed in slices, with ``__pos`` and ``__slice``."""
    sort = [F.col(key) for key in keys] + list(order_by)
    return cut_lineage(
        df.repartitionByRange(slices, *sort).sortWithinPartitions(*sort)
        .withColumn("__pos", F.monotonically_increasing_id())
        .withColumn("__slice", F.shiftright("__pos", _INDEX_BITS)))


def _computed(sliced, columns, keys, wanted):
    """``columns`` of slices and the wanted ones."""
    carry = _carry(sliced, keys, wanted)
    window = Window.partitionBy("__slice", *keys).orderBy("__pos")
    local = sliced.withColumns(_window_columns(window, wanted)).withColumns({
        "__first": F.lag("__pos").over(window).isNull(),
        "__last": F.lead("__pos").over(window).isNull()})
    match = [F.col("l.__slice") == F.col("c.__slice")] + [
        F.col(f"l.{key}").eqNullSafe(F.col(f"c.{key}")) for key in keys]
    joined = local.alias("l").join(F.broadcast(carry).alias("c"), match, "left")
    result = [F.col(f"l.{name}") for name in columns]
    if wanted.row_number:
        result.append((F.col(f"l.{wanted.row_number}") + F.coalesce("c.__rows_before", F.lit(0)))
                      .alias(wanted.row_number))
    for name in wanted.running_sum:
        # NULL only while no non-NULL value has been seen, as in a plain window.
        result.append(F.when(F.col(f"l.{name}").isNull(), F.col(f"c.__sum_{name}")).otherwise(
            F.col(f"l.{name}") + F.coalesce(F.col(f"c.__sum_{name}"), F.lit(0))).alias(name))
    for name in wanted.lag:
        result.append(F.when(F.col("l.__first"), F.col(f"c.__lag_{name}"))
                      .otherwise(F.col(f"l.{name}")).alias(name))
    for name in wanted.lead:
        result.append(F.when(F.col("l.__last"), F.col(f"c.__lead_{name}"))
                      .otherwise(F.col(f"l.{name}")).alias(name))
    return joined.select(*result)


def _carry(sliced, keys, wanted):
    """Per (slice, key) that does not stand alone: what its neighbours contribute."""
    parts = [F.count(F.lit(1)).alias("__n")]
    parts += [F.sum(source).alias(f"__part_{name}") for name, source in wanted.running_sum.items()]
    parts += [F.max_by(F.struct(source), "__pos").alias(f"__tail_{name}")
              for name, source in wanted.lag.items()]
    parts += [F.min_by(F.struct(source), "__pos").alias(f"__head_{name}")
              for name, source in wanted.lead.items()]
    summary = sliced.groupBy("__slice", *keys).agg(*parts)
    # One row per slice and key, so a window over it holds at most one row per slice.
    order = Window.partitionBy(*keys).orderBy("__slice")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    columns = {"__rows_before": F.sum("__n").over(before),
               "__more_after": F.lead("__n").over(order).isNotNull()}
    columns |= {f"__sum_{name}": F.sum(f"__part_{name}").over(before) for name in wanted.running_sum}
    columns |= {f"__lag_{name}": F.lag(f"__tail_{name}").over(order)[source]
                for name, source in wanted.lag.items()}
    columns |= {f"__lead_{name}": F.lead(f"__head_{name}").over(order)[source]
                for name, source in wanted.lead.items()}
    return (summary.withColumns(columns)
            .where(F.col("__rows_before").isNotNull() | F.col("__more_after"))
            .select("__slice", *keys, *columns))


def _helpers(carry, keys):
    return ["__pos"] + [name for name in carry.columns if name not in keys]


def row_numbers(df: DataFrame, order_by, partition_by=(), name: str = "row_number", **options) -> DataFrame:
    """Consecutive numbers from 1, per key or over the whole table."""
    return ordered_columns(df, order_by, Wanted(row_number=name), partition_by, **options)


def running_sum(df: DataFrame, value: str, order_by, partition_by=(),
                name: str = "running_total", **options) -> DataFrame:
    """Sum of all rows up to and including this one."""
    return ordered_columns(df, order_by, Wanted(running_sum={name: value}), partition_by, **options)


def moving_sum_of_two(df: DataFrame, value: str, order_by, partition_by=(),
                      name: str = "moving_sum", **options) -> DataFrame:
    """Sum of this row and the one before it."""
    both = ordered_columns(df, order_by, Wanted(lag={"__previous": value}), partition_by, **options)
    return both.withColumn(
        name, F.coalesce(F.col(value) + F.col("__previous"), F.col(value), F.col("__previous"))
    ).drop("__previous")


def neighbours(df: DataFrame, value: str, order_by, partition_by=(), previous: str = "previous",
               following: str = "following", **options) -> DataFrame:
    """The value of the row before and of the row after."""
    wanted = Wanted(lag={previous: value}, lead={following: value})
    return ordered_columns(df, order_by, wanted, partition_by, **options)


def ranks(df: DataFrame, measure: str, partition_by=(), rank: str = "rank",
          dense_rank: str = "dense_rank", descending: bool = True, **options) -> DataFrame:
    """RANK and DENSE_RANK by one measure, with any number of ties.

    Ranks depend only on the distinct measures of a key and how often each
    occurs, so the ordered step runs on that smaller table and joins back.
    """
    keys = list(partition_by)
    levels = df.groupBy(*keys, measure).agg(F.count(F.lit(1)).alias("__ties"))
    order = F.col(measure).desc() if descending else F.col(measure).asc()
    ranked = ordered_columns(
        levels, [order], Wanted(row_number=dense_rank, running_sum={"__upto": "__ties"}),
        keys, **options)
    ranked = ranked.select(
        *keys, measure, dense_rank, (F.col("__upto") - F.col("__ties") + 1).alias(rank))
    ranked = ranked.select(*keys, measure, rank, dense_rank)
    return attach(df, ranked, [*keys, measure])


def share_of_group(df: DataFrame, value: str, partition_by: Sequence[str],
                   group_total: str = "group_total", share: str = "share_pct",
                   digits: int = 2) -> DataFrame:
    """Group total and per cent share on every row.

    The totals are aggregated first (partial sums before the shuffle) and
    joined back.
    """
    totals = df.groupBy(*partition_by).agg(F.sum(value).alias(group_total))
    return attach(df, totals, list(partition_by)).withColumn(
        share, percent(F.col(value), F.col(group_total), digits))


def sessions(df: DataFrame, key: str, ts: str, gap: str, tie_break: str,
             name: str = "session_number", **options) -> DataFrame:
    """Number the activity sessions of each key: a new one after ``gap`` of silence."""
    order = [F.col(ts), F.col(tie_break)]
    # Both passes run on the same slices: one sort, one checkpoint.
    sliced = _slices(df, [key], order, options.get("slices") or _shuffle_partitions(df))
    held = [*df.columns, "__pos", "__slice"]
    stepped = _computed(sliced, held, [key], Wanted(lag={"__before": ts}))
    fresh = F.col("__before").isNull() | (
        F.col(ts) >= F.col("__before") + F.expr(f"INTERVAL {gap}"))
    flagged = stepped.withColumn("__fresh", fresh.cast("long"))
    return _computed(flagged, df.columns, [key], Wanted(running_sum={name: "__fresh"}))


def followed_by(df: DataFrame, key: str, ts: str, kind: str, first: str, then: str,
                within: str, tie_break: str, **options) -> DataFrame:
    """Rows of kind ``first`` whose very next row of the key is ``then`` in time."""
    order = [F.col(ts), F.col(tie_break)]
    wanted = Wanted(lead={"next_kind": kind, "next_ts": ts})
    return (ordered_columns(df, order, wanted, [key], **options)
            .where((F.col(kind) == first) & (F.col("next_kind") == then)
                   & (F.col("next_ts") <= F.col(ts) + F.expr(f"INTERVAL {within}"))))
