"""Patterns of several steps in the events of a key.

A match begins at each event that meets the first step; every further step takes
the first later event that meets it, or, if the step is ``strict``, the very next
event of the key, which must meet it. The last event must be within the given time
of the first. Events go by time, then by a tie-break column, which should be
unique within a key and time. Events without a time belong to no match.

On a table each step's events are numbered within the key; the next one after an
event has the running count plus one as its number, so a step is a join on (key,
number) with one row on the far side. The running counts come from sliced windows,
and a key may hold any share of the rows.

On a stream a key's events wait until the watermark has passed them and are then
replayed in order, so it does not matter in which order they came. State holds the
waiting events and the unfinished matches, which leave it when the watermark has
passed their time. Rows later than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brightwell.operators.ordered import Wanted, ordered_columns
from brightwell.operators.skew import attach
from brightwell.streaming.combine import with_watermark


@dataclass(frozen=True)
class Step:
    """A named step: an SQL condition on the event's columns. NULL does not meet it."""

    name: str
    condition: str
    strict: bool = False


def find(df: DataFrame, key: str, ts: str, tie_break: str, steps: Sequence[Step], within: str,
         delay: str = "10 minutes", slices: int | None = None) -> DataFrame:
    """One row per match: ``key``, and ``<step>_ts``, ``<step>_<tie_break>`` of every step."""
    if not steps or len({step.name for step in steps}) < len(steps):
        raise ValueError("steps need different names")
    marks = [F.coalesce(F.expr(step.condition), F.lit(False)).cast("long").alias(f"__met{i}") for i, step in enumerate(steps)]
    if df.isStreaming:
        return _replayed(df, key, ts, tie_break, steps, marks, within, delay)
    events = df.where(F.col(ts).isNotNull()).select(F.col(key).alias("__key"), F.col(ts).alias("__ts"), F.col(tie_break).alias("__tie"), *marks)
    wanted = Wanted(row_number="__place", running_sum={f"__upto{i}": f"__met{i}" for i in range(1, len(steps))})
    placed = ordered_columns(events, ["__ts", "__tie"], wanted, ["__key"], slices)
    placed = placed.where(" OR ".join(f"__met{i} = 1" for i in range(len(steps))))

    last = len(steps) - 1

    def met(i: int, *extra) -> DataFrame:
        """Events of step ``i``; ``__number`` is what the next step's event has as its number."""
        following = [(F.col(f"__upto{i + 1}") + 1).alias(f"__number{i + 1}")] if i < last else []
        return placed.where(f"__met{i} = 1").select(
            "__key", F.col("__ts").alias(f"__ts{i}"), F.col("__tie").alias(f"__tie{i}"), F.col("__place").alias(f"__place{i}"), *extra, *following)
    found = met(0)
    for i in range(1, len(steps)):
        number = f"__number{i}"
        found = attach(found, met(i, F.col(f"__upto{i}").alias(number)), ["__key", number]).drop(number)
        # No later event of the step leaves nulls, which no comparison takes.
        found = found.where(F.col(f"__place{i}") == F.col(f"__place{i - 1}") + 1 if steps[i].strict else F.col(f"__place{i}").isNotNull())
    close = found.where(F.col(f"__ts{last}") <= F.col("__ts0") + F.expr(f"INTERVAL {within}"))
    return close.select(F.col("__key").alias(key), *[
        F.col(f"__{what}{i}").alias(f"{step.name}_{name}") for i, step in enumerate(steps) for what, name in (("ts", "ts"), ("tie", tie_break))])


def _replayed(df: DataFrame, key: str, ts: str, tie_break: str, steps: Sequence[Step], marks, within: str, delay: str) -> DataFrame:
    timed = with_watermark(df.select("*", *marks), ts, delay)
    types = dict(timed.dtypes)
    span, strict, n = pd.Timedelta(within).value // 1000, [step.strict for step in steps], len(steps)
    flags = sum((F.col(f"__met{i}") * (1 << i) for i in range(1, n)), F.col("__met0"))
    events = timed.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("__key"), F.col(ts).alias("__ts"), F.unix_micros(ts).alias("__micros"),
        F.col(tie_break).cast("string").alias("__tie"), F.col(tie_break).alias("__order"), flags.cast("long").alias("__flags"))
    names = [key, *[f"{step.name}_{name}" for step in steps for name in ("ts", tie_break)]]
    kinds = [types[key], *[kind for _ in steps for kind in ("long", "string")]]

    def advance(run: list, event: tuple) -> list | None:
        """The run after ``event``: one step further, as it was, or None if a strict step failed."""
        at = len(run)
        if event[2] >> at & 1:
            return [*run, event[:2]]
        return None if strict[at] else run

    def replay(waiting: list, runs: list, mark: int) -> tuple[list, list, list]:
        """Events before the watermark in order: (still waiting, unfinished runs, finished ones)."""
        done = []
        for event in sorted(e for e in waiting if e[0] < mark):
            moved = [advance(run, (event[0], event[2], event[3])) for run in runs if event[0] <= run[0][0] + span]
            if event[3] & 1:
                moved.append([(event[0], event[2])])
            done += [run for run in moved if run is not None and len(run) == n and run[-1][0] <= run[0][0] + span]
            runs = [run for run in moved if run is not None and len(run) < n]
        return [e for e in waiting if e[0] >= mark], [run for run in runs if run[0][0] + span >= mark], done

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        waiting, runs = [], []
        if state.exists:
            *events_held, run_times, run_ties = state.get
            waiting = list(zip(*events_held))
            runs = [list(zip(t, i)) for t, i in zip(run_times, run_ties)]
        if not state.hasTimedOut:
            for batch in batches:
                fresh = zip(batch["__micros"], batch["__order"].map(_sortable), batch["__tie"], batch["__flags"])
                waiting += [(int(t), o, i, int(f)) for t, o, i, f in fresh if t >= mark]
        waiting, runs, done = replay(waiting, runs, mark)
        if waiting or runs:
            state.update((*[[e[k] for e in waiting] for k in range(4)],
                          [[t for t, _ in run] for run in runs], [[i for _, i in run] for run in runs]))
            soonest = min([e[0] for e in waiting] + [run[0][0] + span for run in runs])
            state.setTimeoutTimestamp(max(soonest // 1000, state.getCurrentWatermarkMs()) + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(group[0], *[v for moment in run for v in moment]) for run in done], columns=names)

    found = events.groupBy("__key").applyInPandasWithState(
        step, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)),
        "times array<long>, orders array<string>, ties array<string>, flags array<long>, run_times array<array<long>>, "
        "run_ties array<array<string>>", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(key, *[
        F.timestamp_micros(name).alias(name) if i % 2 == 0 else F.col(name).cast(types[tie_break]).alias(name) for i, name in enumerate(names[1:])])


def _sortable(value) -> str | None:
    """A tie-break as text that sorts as the value does: numbers by their digits, texts as they are."""
    if value is None or pd.isna(value):
        return ""
    if isinstance(value, str):
        return value
    whole = int(value)
    return f"{whole + (1 << 64):022d}"
