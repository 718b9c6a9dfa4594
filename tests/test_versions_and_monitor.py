"""Versioned tables and pushed metrics of streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brightwell.operators import versions
from brightwell.sinks import streams as sinks
from brightwell.streaming import monitor, run
from tests.conftest import at, rows
from tests.test_streaming import STORY, events_stream


@pytest.mark.parametrize("slices", [None, 30])
def test_rows_see_the_version_of_their_time(spark, slices):
    draw, base = random.Random(4), at("08:00:00")
    def moment():
        return draw.choice([None, *[base + dt.timedelta(minutes=draw.randrange(60))] * 9])
    known = [(draw.choice(["a", "a", "a", "b", None]), moment(), draw.randrange(50), "x") for _ in range(80)]
    facts = [(i, draw.choice(["a", "a", "b", "c", None]), moment()) for i in range(150)]
    facts_df = spark.createDataFrame(facts, "id int, k string, ts timestamp")
    known_df = spark.createDataFrame(known, "k string, since timestamp, rate int, __row string")
    got = versions.as_of(facts_df, known_df, "k", "ts", "since", slices=slices)
    assert got.columns == ["id", "k", "ts", "version_k", "version_since", "version_rate", "version___row"]

    def valid(k, ts):
        before = [v for v in known if v[0] == k and v[1] is not None and ts is not None and k is not None and v[1] <= ts]
        return max(before, key=lambda v: (v[1], v[2]), default=(None, None, None, None))
    assert rows(got, "id", "version_since", "version_rate") == rows(spark.createDataFrame(
        [(i, *valid(k, ts)[1:3]) for i, k, ts in facts], "id int, s timestamp, r int"))
    assert versions.as_of(facts_df, known_df.limit(0), "k", "ts", "since").where("version_rate IS NOT NULL").count() == 0
    assert versions.as_of(facts_df.limit(0), known_df, "k", "ts", "since").count() == 0


def test_batches_see_a_table_that_changes(spark, tmp_path):
    table = str(tmp_path / "rates")
    def add(rate, since):
        spark.createDataFrame([("a", at(since), rate)], "user string, since timestamp, rate int").write.mode("append").parquet(table)
    add(1, "09:00:00")
    seen = []

    def write(df, number):
        seen.extend((number, r.id, r.version_rate) for r in df.where("user = 'a'").collect())
        if number == 0:
            add(2, "10:05:00")
    stream = events_stream(spark, tmp_path / "in", *STORY[:2])
    step = versions.refreshed(lambda: spark.read.parquet(table), "user", "ts", "since", write)
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(set(seen)) == [(0, 1, 1), (1, 3, 2)]


def batch(number, value, run_id="r"):
    return {"query": "q", "run_id": run_id, "batch_id": number, "at": "t", "batch_ms": value}


def test_alerts_with_hysteresis():
    told, lines = [], []
    watch = monitor.Monitor([monitor.Rule("slow", "batch_ms", 100, clear_at=50, patience=2)], lines.append,
                            lambda a: told.append((a["batch_id"], a["state"], a["value"])))
    for number, value in enumerate([120, 90, 101, 130, 70, 99, 140, None, 50, 120, 130]):
        watch.take(batch(number, value))
        watch.take(batch(number, 10_000))  # reported again
    assert told == [(3, "on", 130), (8, "off", 50), (10, "on", 130)] and len(lines) == 11
    watch.take(batch(0, 150, "s"))
    assert len(told) == 3
    for wrong in ({"clear_at": 200}, {"patience": 0}):
        with pytest.raises(ValueError):
            monitor.Rule("slow", "batch_ms", 100, **wrong)


def test_every_batch_is_written_once(spark, tmp_path):
    progress, alerts = str(tmp_path / "progress"), str(tmp_path / "alerts")
    watch = monitor.Monitor([monitor.Rule("rows", "input_rows", 2)], monitor.to_folder(spark, progress, monitor.PROGRESS),
                            monitor.to_folder(spark, alerts, monitor.ALERTS))
    stop = monitor.watch(spark, watch)
    try:
        stream = events_stream(spark, tmp_path / "in", *STORY)
        run.drain(sinks.to_memory(stream.withWatermark("ts", "1 minute").groupBy("user").agg(F.count(F.lit(1)).alias("n")), "s_watched", "complete",
                                  trigger=sinks.DRAIN))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        stop()
    found = spark.read.parquet(progress).where("input_rows > 0")
    assert rows(found, "batch_id", "input_rows") == [(i, len(b)) for i, b in enumerate(STORY)]
    assert rows(spark.read.parquet(alerts), "batch_id", "state", "value") == [(1, "on", 3.0), (2, "off", 1.0)]
    assert found.where("state_rows > 0 AND batch_ms >= 0").count() == len(STORY)
