"""Stream sinks: each starts one query with its own checkpoint."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from brightwell.sources.jdbc import Connection

DRAIN = "available now"  # process what is there, then stop
ONCE = "once"


def _writer(df: DataFrame, checkpoint: str | None, mode: str, trigger: str | None,
            name: str | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger in (DRAIN, ONCE):
        # Spark replaced the single-batch trigger by the draining one.
        return writer.trigger(availableNow=True)
    if trigger and trigger.startswith("continuous "):
        return writer.trigger(continuous=trigger.removeprefix("continuous "))
    return writer.trigger(processingTime=trigger) if trigger else writer


def start(df: DataFrame, sink: str, checkpoint: str | None = None, mode: str = "append",
          trigger: str | None = None, name: str | None = None, path: str | None = None,
          partition_by: Sequence[str] = (), **options) -> StreamingQuery:
    """Start any built-in sink."""
    writer = _writer(df, checkpoint, mode, trigger, name).format(sink).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path) if path else writer.start()


def to_console(df: DataFrame, mode: str = "update", rows: int = 20, truncate: bool = False,
               **settings) -> StreamingQuery:
    return start(df, "console", mode=mode, numRows=rows, truncate=truncate, **settings)


def to_memory(df: DataFrame, name: str, mode: str = "append", **settings) -> StreamingQuery:
    """An in-memory table on the driver, for tests and small summaries only."""
    return start(df, "memory", mode=mode, name=name, **settings)


def to_parquet(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
               **settings) -> StreamingQuery:
    return start(df, "parquet", checkpoint, path=path, partition_by=partition_by, **settings)


def to_json(df: DataFrame, path: str, checkpoint: str, **settings) -> StreamingQuery:
    return start(df, "json", checkpoint, path=path, **settings)


def to_csv(df: DataFrame, path: str, checkpoint: str, header: bool = True, **settings) -> StreamingQuery:
    return start(df, "csv", checkpoint, path=path, header=header, **settings)


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append",
             **settings) -> StreamingQuery:
    """Rows of (key, value) to a topic: append for alerts, update for summaries."""
    return start(messages, "kafka", checkpoint, mode=mode,
                 **kafka_sink_options(servers, topic), **settings)


def each_batch(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "update", trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Hand every micro-batch to a function as a table; there it may be sorted,
    joined, and written to several places."""
    return _writer(df, checkpoint, mode, trigger, name).foreachBatch(handle).start()


def fan_out(routes: Mapping[str, Callable[[DataFrame], DataFrame]], folder: str,
            file_format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A batch handler that writes every route of one input to its own folder.

    The input is read once per batch. Each batch owns a sub-folder named by its
    id and overwrites it, so a repeated batch leaves no duplicates.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, pick in routes.items():
                (pick(batch).write.mode("overwrite").format(file_format)
                 .save(f"{folder}/{name}/batch_id={batch_id}"))
        finally:
            batch.unpersist()
    return handle


def sorted_report(order: Sequence, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A batch handler that sorts first (update-mode streams cannot be sorted)."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        write(batch.orderBy(*order), batch_id)
    return handle


def jdbc_batches(connection: Connection, table: str, id_column: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """A batch handler that appends to a database table once per batch.

    Rows carry the batch id. A batch that already arrived is skipped; a batch
    of which only some partitions arrived is completed by its missing rows.
    """
    from brightwell.sinks.jdbc import write_table
    from brightwell.sources.jdbc import read_query

    def handle(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn(id_column, F.lit(batch_id).cast("long"))
        try:
            present = read_query(batch.sparkSession, connection,
                                 f"SELECT * FROM {table} WHERE {id_column} = {int(batch_id)}")
            names = {name.lower(): name for name in present.columns}
            present = present.select(*[F.col(names[c.lower()]).alias(c) for c in tagged.columns])
            tagged = tagged.exceptAll(present)
        except Exception as error:  # the first batch creates the table
            if not _table_is_missing(error):
                raise
        write_table(tagged, connection, table, mode="append")
    return handle


def _table_is_missing(error: Exception) -> bool:
    """Whether the database says that a table is missing; a missing driver class or
    host, which also is "not found", is not that."""
    text = str(error).lower()
    missing = re.search(r"(table|relation|object)\b.{0,200}?(does not exist|doesn't exist|not found)", text, re.S)
    return bool(missing) and not re.search(r"classnotfound|no suitable driver|unknown ?host", text)
