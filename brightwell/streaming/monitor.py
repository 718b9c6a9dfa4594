"""Metrics of streaming queries, pushed as batches end.

A ``Monitor`` is a listener: Spark calls it after every batch of every query of the
session, so nothing polls and no batch is missed. Each batch gives one row, also
if Spark reports it again while the query idles. Rules watch a metric and raise
an alert that stays on until the metric is well below the limit, so that a value
near the limit does not switch it on and off.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = ("query string, query_id string, run_id string, batch_id long, at string, input_rows long, input_per_second double, "
            "processed_per_second double, batch_ms long, watermark string, state_rows long, state_bytes long, late_rows long")
ALERTS = "rule string, query string, batch_id long, at string, state string, value double"


@dataclass(frozen=True)
class Rule:
    """Raise when ``metric`` is above ``limit`` in ``patience`` batches in a row, clear when it
    is at or below ``clear_at`` (the limit unless given). A metric that is missing counts for neither."""

    name: str
    metric: str
    limit: float
    clear_at: float | None = None
    patience: int = 1

    def __post_init__(self):
        if self.patience < 1 or (self.clear_at is not None and self.clear_at > self.limit):
            raise ValueError("a rule needs patience of 1 or more and clears at its limit or below")


class Monitor(StreamingQueryListener):
    """Rows of progress to ``write_progress`` and alerts to ``write_alert``, as dictionaries."""

    def __init__(self, rules: Sequence[Rule] = (), write_progress: Callable[[dict], None] | None = None,
                 write_alert: Callable[[dict], None] | None = None):
        self.rules, self.write_progress, self.write_alert = tuple(rules), write_progress, write_alert
        self.last: dict[str, int] = {}
        self.streak: dict[tuple[str, str], int] = {}
        self.raised: set[tuple[str, str]] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.take(row_of(event.progress))

    def onQueryTerminated(self, event) -> None:
        """Alerts of a query that ended are over."""
        run = str(event.runId)
        self.last.pop(run, None)
        for key in [k for k in self.raised if k[1] == run]:
            self.raised.discard(key)
        for key in [k for k in self.streak if k[1] == run]:
            del self.streak[key]

    def take(self, row: dict) -> None:
        """One batch; a batch that was taken before is passed over."""
        run = row["run_id"]
        if self.last.get(run, -1) >= row["batch_id"]:
            return
        self.last[run] = row["batch_id"]
        if self.write_progress:
            self.write_progress(row)
        for rule in self.rules:
            self._judge(rule, row)

    def _judge(self, rule: Rule, row: dict) -> None:
        key, value = (rule.name, row["run_id"]), row.get(rule.metric)
        if value is None:
            return
        self.streak[key] = self.streak.get(key, 0) + 1 if value > rule.limit else 0
        if key not in self.raised and self.streak[key] >= rule.patience:
            self.raised.add(key)
            self._tell(rule, row, "on", value)
        elif key in self.raised and value <= (rule.limit if rule.clear_at is None else rule.clear_at):
            self.raised.discard(key)
            self._tell(rule, row, "off", value)

    def _tell(self, rule: Rule, row: dict, state: str, value: float) -> None:
        if self.write_alert:
            self.write_alert({"rule": rule.name, "query": row["query"], "batch_id": row["batch_id"], "at": row["at"], "state": state,
                              "value": float(value)})


def row_of(progress) -> dict:
    """The columns of ``PROGRESS`` of one report of Spark."""
    operators = list(progress.stateOperators or [])
    times = progress.eventTime or {}
    return {
        "query": progress.name, "query_id": str(progress.id), "run_id": str(progress.runId), "batch_id": progress.batchId,
        "at": progress.timestamp, "input_rows": progress.numInputRows, "input_per_second": _number(progress.inputRowsPerSecond),
        "processed_per_second": _number(progress.processedRowsPerSecond), "batch_ms": progress.batchDuration,
        "watermark": times.get("watermark"), "state_rows": sum(o.numRowsTotal for o in operators),
        "state_bytes": sum(o.memoryUsedBytes for o in operators), "late_rows": sum(o.numRowsDroppedByWatermark for o in operators)}


def _number(value) -> float | None:
    return None if value is None or value != value else float(value)


def to_folder(spark: SparkSession, folder: str, schema: str) -> Callable[[dict], None]:
    """A writer that appends each row to a shared folder as a file of its own, whole or not at all."""
    names = [column.split()[0] for column in schema.split(", ")]

    def write(row: dict) -> None:
        spark.createDataFrame([tuple(row[name] for name in names)], schema).coalesce(1).write.mode("append").parquet(folder)
    return write


def watch(spark: SparkSession, monitor: Monitor) -> Callable[[], None]:
    """Start listening; call the result to stop."""
    spark.streams.addListener(monitor)
    return lambda: spark.streams.removeListener(monitor)
