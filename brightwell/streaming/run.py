"""Running, watching and stopping queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def drain(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Wait for an available-now query to finish, however long its backlog is;
    raises its error, if any. With a ``timeout`` in seconds, a query that is still
    active then is stopped, and that is an error."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"query {query.name or query.id} still active after {timeout} s")
    return query


def drain_all(queries: Iterable[StreamingQuery], timeout: int | None = None) -> None:
    for query in list(queries):
        drain(query, timeout)


def run_until_any_stops(spark: SparkSession) -> None:
    """Block until one query ends, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        stop_all(spark)


def stop_all(spark: SparkSession) -> list[str]:
    """Stop every active query after its current batch; returns their names."""
    stopped = []
    for query in spark.streams.active:
        stopped.append(query.name or str(query.id))
        query.stop()
    return stopped


def progress(query: StreamingQuery) -> dict[str, object]:
    """Rows, rates, state size and watermark of the last batch."""
    last = query.lastProgress
    if last is None:
        return {}
    state = last["stateOperators"] or []
    return {
        "name": last["name"], "batch_id": last["batchId"], "input_rows": last["numInputRows"],
        "input_rows_per_second": last["inputRowsPerSecond"],
        "processed_rows_per_second": last["processedRowsPerSecond"],
        "state_rows": sum(s["numRowsTotal"] for s in state),
        "dropped_late_rows": sum(s["numRowsDroppedByWatermark"] for s in state),
        "watermark": (last["eventTime"] or {}).get("watermark"),
    }


def observed(df: DataFrame, name: str, bad: str | None = None) -> DataFrame:
    """Count rows (and bad rows) on the way, without another pass; the counts
    appear in the progress of the query under ``name``."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if bad:
        metrics.append(F.count_if(F.expr(bad)).alias("bad_rows"))
    return df.observe(name, *metrics)
