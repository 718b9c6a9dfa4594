"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from brightwell.sources.files import to_schema


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a socket. For trying things out: it cannot be replayed."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def files(spark: SparkSession, path: str, schema: str | T.StructType, file_format: str = "json",
          max_files: int | None = None, archive: str | None = None, **options) -> DataFrame:
    """New files of a folder. ``archive`` moves finished files there."""
    reader = spark.readStream.format(file_format).schema(to_schema(schema)).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def kafka_options(servers: str, topics: str, starting: str = "latest", fail_on_loss: bool = False,
                  max_offsets: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Reader options. ``max_offsets`` bounds a batch; ``min_partitions`` splits
    large topic partitions over more tasks."""
    chosen = {"kafka.bootstrap.servers": servers, "subscribe": topics,
              "startingOffsets": starting, "failOnDataLoss": str(fail_on_loss).lower()}
    if max_offsets is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        chosen["minPartitions"] = str(min_partitions)
    return chosen


def kafka(spark: SparkSession, servers: str, topics: str, **settings) -> DataFrame:
    """Envelope rows of Kafka topics; needs the Kafka connector on the class path."""
    return (spark.readStream.format("kafka")
            .options(**kafka_options(servers, topics, **settings)).load())
