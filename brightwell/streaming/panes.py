"""Sliding windows from mergeable panes.

A sliding window that is a group of its own repeats every row for each window
that holds it. Here rows are aggregated once, into panes as long as the common
divisor of window and slide. The windows of a key change only where a pane enters
or leaves them, so states are merged once for each such place, and a result is
written out for the windows up to the next place.

Distinct counts are exact: a value is in all windows from the first that holds one
of its panes to the last, so its panes join to intervals of windows. An interval
adds one where it begins and takes one away where it ends; the running sum of these
is the count, and no value is repeated for each window.

A key's time line is cut into blocks of windows, so no task holds the whole of a
key, be it the only one. Rows without a time are in no window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Windows of a block; a block is at least as long as a window.
BLOCK = 4096
EPOCH_DAY = 86_400_000_000
MERGES = {
    "sum": lambda column, window: F.sum(column).over(window), "min": lambda column, window: F.min(column).over(window),
    "max": lambda column, window: F.max(column).over(window), "or": lambda column, window: F.bit_or(column).over(window),
    "set": lambda column, window: F.array_sort(F.array_distinct(F.flatten(F.collect_list(column).over(window))))}


@dataclass(frozen=True)
class State:
    """An aggregate of the rows of a pane and how panes are merged: one of ``MERGES``.

    The merged value is the aggregate of all rows of the panes; a set is an array."""

    aggregate: Column
    merge: str = "sum"


def micros(ts: str | Column, kind: str) -> Column:
    """Microseconds since 1970 of a time; of one without a zone by its own clock."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    if kind == "timestamp":
        return F.unix_micros(ts)
    if SparkSession.active().conf.get("spark.sql.session.timeZone") == "UTC":
        return F.unix_micros(ts.cast("timestamp"))
    second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return F.unix_date(F.to_date(ts)) * F.lit(EPOCH_DAY) + (F.hour(ts) * 3600 + F.minute(ts) * 60) * F.lit(1_000_000).cast("long") + second


def from_micros(value: Column, kind: str) -> Column:
    if kind == "timestamp":
        return F.timestamp_micros(value)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=value / F.lit(1_000_000).cast("decimal(10,0)"))


def _floor(value: Column, by: int) -> Column:
    """Whole quotient, rounded down, exact for any long."""
    return ((value - F.pmod(value, F.lit(by))) / by).cast("long") if by > 1 else value


def sliding(df: DataFrame, size: str, slide: str, keys: Sequence[str], states: Mapping[str, State],
            distinct: Mapping[str, str] | None = None, where: Column | None = None,
            ts: str = "event_timestamp", block: int = BLOCK) -> DataFrame:
    """window_start, window_end, ``keys``, the merged states and distinct counts of a table's
    sliding windows. ``distinct`` names counts of columns (nulls are not counted); ``where``
    is a condition on the results that is tested before they are written out for each window.
    """
    kind = dict(df.dtypes)[ts]
    if kind not in ("timestamp", "timestamp_ntz"):
        raise ValueError(f"{ts} must be a timestamp")
    length, hop = (pd.Timedelta(span).value // 1000 for span in (size, slide))
    pane = math.gcd(length, hop)
    width, step = length // pane, hop // pane
    block = max(block, -(-width // step))
    keys, distinct = list(keys), dict(distinct or {})
    rows = df.where(F.col(ts).isNotNull()).withColumn("__pane", _floor(micros(ts, kind), pane))

    # A pane is in the windows from ``__enter`` to before ``__leave``, counted in slides.
    at = F.col("__pane")
    enter, leave = _floor(at - (width - step), step), _floor(at, step) + 1
    first = F.col("__block") * block

    def blocks(begin: str) -> Column:
        return F.explode(F.sequence(_floor(F.col(begin), block), _floor(F.col("__leave") - 1, block))).alias("__block")

    panes = rows.groupBy("__pane", *keys).agg(*[state.aggregate.alias(name) for name, state in states.items()])
    panes = panes.withColumns({"__enter": enter, "__leave": leave}).where(F.col("__enter") < F.col("__leave"))
    cut = panes.select("*", blocks("__enter"))
    types = {field.name: field.dataType for field in cut.schema}
    nothing = [F.lit(None).cast(types[name]).alias(name) for name in states]
    counts = [F.lit(None).cast("long").alias(name) for name in distinct]

    def mark(window: Column) -> Column:
        return F.struct((window * step).alias("__at"), window.alias("__mark"), F.lit(None).cast("int").alias("__one"), *nothing)
    ends = F.when(F.col("__leave") < first + block, F.col("__leave"))
    own = F.struct(at.alias("__at"), F.lit(None).cast("long").alias("__mark"), F.lit(1).alias("__one"), *[F.col(name) for name in states])
    line = cut.select(*keys, "__block", F.inline(F.array(own, mark(F.greatest("__enter", first)), mark(ends))))
    line = line.where(F.col("__at").isNotNull()).select("*", *counts)
    for name, column in distinct.items():
        line = line.unionByName(_changes(rows, keys, column, enter, leave, blocks, first, block).select(
            *keys, "__block", (F.col("__window") * step).alias("__at"), F.lit(None).cast("long").alias("__mark"),
            F.lit(None).cast("int").alias("__one"), *nothing,
            *[(F.col("__change") if n == name else F.lit(None).cast("long")).alias(n) for n in distinct]))

    order = Window.partitionBy(*keys, "__block").orderBy("__at")
    inside, so_far = order.rangeBetween(Window.currentRow, width - 1), order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    merged = line.select(
        *keys, "__block", "__at", "__mark", F.count("__one").over(inside).alias("__one"),
        *[MERGES[state.merge](F.col(name), inside).alias(name) for name, state in states.items()],
        *[F.coalesce(F.sum(name).over(so_far), F.lit(0)).alias(name) for name in distinct])
    # Of several marks at one place all but one end at once.
    spans = merged.where(F.col("__mark").isNotNull()).withColumn(
        "__next", F.coalesce(F.lead("__mark").over(order), first + block))
    kept = spans.where((F.col("__one") > 0) & (F.col("__next") > F.col("__mark")))
    if where is not None:
        kept = kept.where(where)
    out = kept.withColumn("__window", F.explode(F.sequence("__mark", F.col("__next") - 1)))
    start = F.col("__window") * F.lit(hop)
    return out.select(from_micros(start, kind).alias("window_start"), from_micros(start + length, kind).alias("window_end"),
                      *keys, *states, *distinct)


def _changes(rows: DataFrame, keys: list[str], column: str, enter: Column, leave: Column, blocks, first: Column, block: int) -> DataFrame:
    """keys, __block, __window, __change: by how much the number of distinct values changes there."""
    seen = rows.where(F.col(column).isNotNull()).select("__pane", *keys, F.col(column).alias("__value")).distinct()
    seen = seen.select(*keys, "__value", enter.alias("__enter"), leave.alias("__leave")).where(F.col("__enter") < F.col("__leave"))
    before = F.lag("__leave").over(Window.partitionBy(*keys, "__value").orderBy("__leave", "__enter"))
    runs = seen.withColumn("__from", F.greatest("__enter", before)).where(F.col("__from") < F.col("__leave"))
    cut = runs.select(*keys, "__from", "__leave", blocks("__from"))
    both = F.array(F.struct(F.greatest("__from", first).alias("__window"), F.lit(1).cast("long").alias("__one")),
                   F.struct(F.when(F.col("__leave") < first + block, F.col("__leave")).alias("__window"), F.lit(-1).cast("long").alias("__one")))
    return (cut.select(*keys, "__block", F.inline(both)).where(F.col("__window").isNotNull())
            .groupBy(*keys, "__block", "__window").agg(F.sum("__one").alias("__change")))
