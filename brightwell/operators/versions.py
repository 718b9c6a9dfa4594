"""Joins with a table whose rows change over time.

``as_of`` gives each row the version of its key that was valid at the row's time:
the last that began then or before. Rows and versions are put on one time line per
key; the running count of versions is the number of the valid one, and a join on
(key, number) with one row on the far side fetches it. The running count comes
from sliced windows, so a key may hold any share of the rows, and no row is paired
with versions that were not valid.

``refreshed`` does this for the batches of a stream, with the versions read anew
for every batch, so that changes of the table reach a running query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.operators.ordered import Wanted, ordered_columns
from brightwell.operators.skew import attach


def as_of(rows: DataFrame, versions: DataFrame, key: str, ts: str, valid_from: str, prefix: str = "version_",
          slices: int | None = None) -> DataFrame:
    """``rows`` with the columns of the valid version under ``prefix``; NULLs if there is none.

    Of versions of a key that begin at the same time the largest by the other columns
    is valid. Rows without a key or a time have no version, and versions without one
    are never valid."""
    facts = rows.select(F.col(key).alias("__key"), F.col(ts).alias("__at"), F.lit(0).cast("long").alias("__is_version"),
                        F.struct("*").alias("__row"), F.lit(None).cast(versions.select(F.struct("*")).schema[0].dataType).alias("__version"))
    known = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("__key"), F.col(valid_from).alias("__at"), F.lit(1).cast("long").alias("__is_version"),
        F.lit(None).cast(facts.schema["__row"].dataType).alias("__row"), F.struct("*").alias("__version"))
    able = F.col("__key").isNotNull() & F.col("__at").isNotNull()
    line = facts.where(able).unionByName(known)
    # Versions come before rows of the same time, in the order of their columns.
    order = [F.col("__at"), F.col("__is_version").desc(), *[F.col(f"__version.{c}") for c in versions.columns]]
    placed = ordered_columns(line, order, Wanted(running_sum={"__number": "__is_version"}), ["__key"], slices)
    numbered = placed.where("__is_version = 1").select("__key", "__number", F.col("__version").alias("__valid"))
    found = attach(placed.where("__is_version = 0").select("__key", "__number", "__row"), numbered, ["__key", "__number"])
    names = [F.col(f"__valid.{c}").alias(f"{prefix}{c}") for c in versions.columns]
    without = facts.where(~able).select("__row", F.col("__version").alias("__valid"))
    return found.select("__row", "__valid").unionByName(without).select("__row.*", *names)


def refreshed(load: Callable[[], DataFrame], key: str, ts: str, valid_from: str,
              write: Callable[[DataFrame, int], None], prefix: str = "version_") -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``: joins a batch with the versions that ``load`` reads
    then, and hands the result to ``write`` with the number of the batch. A batch that is
    repeated after a failure is joined with what the table holds by then; its rows see the
    versions of their own time, so only versions that came late can differ."""
    def step(batch: DataFrame, number: int) -> None:
        write(as_of(batch, load(), key, ts, valid_from, prefix), number)
    return step
