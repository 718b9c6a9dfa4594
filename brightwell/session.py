"""Session set-up and the two session facts the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Only settings whose default does not already suit large batch jobs.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

STREAM_DEFAULTS = {
    # State that outgrows the heap stays on local disk, with its changelog in
    # the checkpoint folder, so a lost executor can be replaced.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.maintenanceInterval": "60s",
    "spark.streaming.stopGracefullyOnShutdown": "true",
}

#: Whether shuffle files go at the end of the query that wrote them.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "brightwell", master: str | None = None,
                  streaming: bool = False, **settings: str) -> SparkSession:
    """Create or reuse a session. ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = dict(DEFAULTS)
    if streaming:
        chosen.update(STREAM_DEFAULTS)
    chosen.update(settings)
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: zone-less columns then mean the same everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Without that setting a
    local session gets a temporary folder; a cluster session is refused, since
    a folder on one machine would be lost with that machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="brightwell-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def for_once(df: DataFrame) -> DataFrame:
    """``df`` for a single action, whose shuffle files go as soon as it ends.

    Otherwise they stay until the driver happens to collect its garbage, which a
    driver with little to do may not for a whole job. Spark decides this when a
    DataFrame is made, so ``df`` itself and the session stay as they were.
    """
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, "false")
    conf.set(RELEASE, "true")
    try:
        return df.select("*")
    finally:
        conf.set(RELEASE, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back."""
    checkpoint_folder(df.sparkSession)
    return for_once(df).checkpoint(eager=True)
