"""Aggregates kept as partial states: sketches per pane, increments, corrections.

A ``Rollup`` keeps, for each key, states that merge: counts and sums, sketches of
distinct values and of quantiles, and for exact extremes and distinct counts how
often each value occurs. New rows are aggregated alone and written as a delta, so
an increment costs what its rows cost. Reading merges the deltas, and may merge
keys as well: days to months, regions to all.

Rows that were wrong are taken back by a retraction, which subtracts their counts
and sums and lowers the counts of their values. Sketches and running extremes
cannot forget a value; a rollup with such metrics refuses retractions.

A delta counts once its line is in the log of commits, which is appended as one
file; until then nobody reads it. The largest committed number is the high-water
mark: an increment at or below it was applied before and changes nothing, and one
that broke off before its commit is simply written again. ``compact`` writes the
merged states as a new base and switches to it by one line of the log. One writer
at a time is assumed; readers see one state or the next, never a mixture.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwell.operators.skew import attach

#: log2 of the registers of a distinct sketch: a standard error of 1.04 / 64 after merging.
LOG_REGISTERS = 12
DISTINCT_ERROR = 1.04 / (1 << LOG_REGISTERS // 2)
#: Size of a quantile sketch: a rank error below 1.4 % with 99 % confidence.
QUANTILE_K = 200
SUMS, VALUES = "sums", "values"


@dataclass(frozen=True)
class Metric:
    """A metric of ``value`` (a column or expression; not needed for a count).

    Kinds: ``count`` and ``sum`` (NULL without values; exact if the column is whole or
    decimal); ``approx_distinct``; ``approx_quantile`` at ``rank``; ``running_min`` and
    ``running_max``; and, from counted values, ``min``, ``max`` and ``distinct``."""

    kind: str
    value: str | Column | None = None
    rank: float = 0.5

    def column(self) -> Column:
        return F.expr(self.value) if isinstance(self.value, str) else self.value


#: Kind: (aggregate of rows, aggregate of states, result of a state).
MERGEABLE = {
    "approx_distinct": (lambda m: F.hll_sketch_agg(m.column(), LOG_REGISTERS), F.hll_union_agg, lambda s, m: F.hll_sketch_estimate(s)),
    "approx_quantile": (lambda m: F.kll_sketch_agg_double(m.column().cast("double"), QUANTILE_K), F.kll_merge_agg_double,
                        lambda s, m: F.kll_sketch_get_quantile_double(s, F.lit(m.rank).cast("double"))),
    "running_min": (lambda m: F.min(m.column()), F.min, lambda s, m: s),
    "running_max": (lambda m: F.max(m.column()), F.max, lambda s, m: s)}
COUNTED = {"min": F.min, "max": F.max, "distinct": lambda value: F.count(value)}
SIGNED = ("count", "sum")


class Rollup:
    """Metrics by ``keys`` in a shared folder: see the module's text."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], metrics: Mapping[str, Metric]):
        unknown = {m.kind for m in metrics.values()} - {*MERGEABLE, *COUNTED, *SIGNED}
        if unknown:
            raise ValueError(f"unknown kinds of metric: {sorted(unknown)}")
        self.spark, self.folder, self.keys, self.metrics = spark, folder.rstrip("/"), list(keys), dict(metrics)
        self.counted = [name for name, m in metrics.items() if m.kind in COUNTED]

    # The log

    def _commits(self) -> list[tuple[str, int]]:
        try:
            return [(r.kind, r.number) for r in self.spark.read.parquet(f"{self.folder}/commits").collect()]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _commit(self, kind: str, number: int) -> None:
        line = self.spark.range(1).select(F.lit(kind).alias("kind"), F.lit(number).cast("long").alias("number"))
        line.coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")

    def mark(self) -> int | None:
        """The high-water mark: the largest number applied."""
        return max((number for _, number in self._commits()), default=None)

    def _parts(self) -> list[str]:
        commits = self._commits()
        base = max((n for kind, n in commits if kind == "base"), default=None)
        deltas = sorted(n for kind, n in commits if kind == "delta" and (base is None or n > base))
        return ([f"{self.folder}/base-{base}"] if base is not None else []) + [f"{self.folder}/delta-{n}" for n in deltas]

    # States

    def partial(self, rows: DataFrame, sign: int = 1) -> dict[str, DataFrame]:
        """States of rows: one table of sums and sketches, one of counted values for each metric with such."""
        states = [(F.count(F.lit(1)) * sign).alias("__rows")]
        for name, m in self.metrics.items():
            if m.kind == "count":
                value = F.count(F.lit(1)) if m.value is None else F.count(m.column())
                states.append((value * sign).alias(name))
            elif m.kind == "sum":
                states += [(F.sum(m.column()) * sign).alias(name), (F.count(m.column()) * sign).alias(f"__n_{name}")]
            elif m.kind in MERGEABLE:
                state = MERGEABLE[m.kind][0](m)
                states.append((state if sign > 0 else F.lit(None)).alias(name))
        made = {SUMS: rows.groupBy(*self.keys).agg(*states)}
        for name in self.counted:
            value = self.metrics[name].column()
            made[f"{VALUES}-{name}"] = rows.where(value.isNotNull()).groupBy(*self.keys, value.alias("__value")).agg(
                (F.count(F.lit(1)) * sign).alias("__n"))
        return made

    def _merged(self, table: str, states: DataFrame, keys: Sequence[str]) -> DataFrame:
        if table != SUMS:
            return states.groupBy(*keys, "__value").agg(F.sum("__n").alias("__n")).where("__n <> 0")
        merged = [F.sum("__rows").alias("__rows")]
        for name, m in self.metrics.items():
            if m.kind in MERGEABLE:
                merged.append(MERGEABLE[m.kind][1](name).alias(name))
            elif m.kind in SIGNED:
                merged += [F.sum(n).alias(n) for n in ([name] if m.kind == "count" else [name, f"__n_{name}"])]
        return states.groupBy(*keys).agg(*merged).where("__rows <> 0")

    def _stored(self, table: str) -> DataFrame | None:
        parts = self._parts()
        return self.spark.read.parquet(*[f"{part}/{table}" for part in parts]) if parts else None

    # Changes

    def apply(self, number: int, rows: DataFrame, retracted: DataFrame | None = None) -> bool:
        """Add increment ``number``; False if it, or a later one, is applied already."""
        mark = self.mark()
        if mark is not None and number <= mark:
            return False
        if retracted is not None and any(m.kind in MERGEABLE for m in self.metrics.values()):
            raise ValueError("sketches and running extremes cannot take rows back")
        made = self.partial(rows)
        if retracted is not None:
            taken = self.partial(retracted, -1)
            made = {table: states.unionByName(taken[table]) for table, states in made.items()}
        for table, states in made.items():
            states.write.mode("overwrite").parquet(f"{self.folder}/delta-{number}/{table}")
        self._commit("delta", number)
        return True

    def advance(self, source: DataFrame, column: str) -> bool:
        """Apply what lies beyond the high-water mark. ``column`` is a whole number that
        rises from increment to increment; rows at or below the mark count as seen."""
        mark = self.mark()
        fresh = source if mark is None else source.where(F.col(column) > mark)
        upper = fresh.agg(F.max(column)).first()[0]
        # Bounded, so that rows that arrive meanwhile are left to the next call.
        return upper is not None and self.apply(int(upper), fresh.where(F.col(column) <= upper))

    def compact(self) -> None:
        """Merge all states into a new base."""
        mark = self.mark()
        if mark is None:
            return
        for table in [SUMS, *[f"{VALUES}-{name}" for name in self.counted]]:
            self._merged(table, self._stored(table), self.keys).write.mode("overwrite").parquet(f"{self.folder}/base-{mark}/{table}")
        self._commit("base", mark)

    # Results

    def read(self, keys: Sequence[str] | None = None, names: Mapping[str, Column] | None = None) -> DataFrame:
        """The metrics by ``keys`` (some of the rollup's, or none). ``names`` makes keys of
        coarser levels from stored ones: ``{"month": trunc(day)}``."""
        keys, names = list(self.keys if keys is None else keys), dict(names or {})
        stored = self._stored(SUMS)
        if stored is None:
            raise ValueError("nothing was applied yet")
        found = self._merged(SUMS, stored.withColumns(names), keys)
        for name in self.counted:
            kind = self.metrics[name].kind
            values = self._merged(f"{VALUES}-{name}", self._stored(f"{VALUES}-{name}").withColumns(names), keys)
            # Without keys both sides are one row.
            of_key = values.groupBy(*keys).agg(COUNTED[kind]("__value").alias(name))
            found = attach(found.withColumn("__all", F.lit(0)), of_key.withColumn("__all", F.lit(0)), [*keys, "__all"]).drop("__all")
            if kind == "distinct":
                found = found.withColumn(name, F.coalesce(name, F.lit(0)))

        def result(name: str, m: Metric) -> Column:
            if m.kind in MERGEABLE:
                return MERGEABLE[m.kind][2](F.col(name), m)
            return F.when(F.col(f"__n_{name}") != 0, F.col(name)) if m.kind == "sum" else F.col(name)
        return found.select(*keys, *[result(name, m).alias(name) for name, m in self.metrics.items()])
