"""Sliding windows from panes against windows that repeat every row."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brightwell.functions.numbers import sample_deviation
from brightwell.plans import derived
from brightwell.plans.registry import Tables
from brightwell.streaming import windows
from brightwell.streaming.panes import State, from_micros, micros, sliding
from tests.conftest import rows

START = dt.datetime(2024, 2, 28, 23, 50)


def events(spark, n=400, kind="timestamp_ntz"):
    draw = random.Random(7)
    made = []
    for i in range(n):
        gap = draw.choice([draw.randrange(3_000), draw.randrange(40_000)])
        at = START + dt.timedelta(seconds=gap, microseconds=draw.choice([0, 1, 999_999]))
        made.append((None if i % 50 == 0 else at, draw.choice(["a", "a", "a", None]), draw.choice([None, *range(6)]), draw.randrange(100)))
    df = spark.createDataFrame(made, "ts timestamp_ntz, k string, who int, v int")
    return df.withColumn("ts", F.col("ts").cast(kind)).withColumn("v", F.col("v").cast("decimal(18,4)"))


def plain(df, size, slide, keys):
    """Spark's own sliding windows."""
    grouped = df.groupBy(F.window("ts", size, slide), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), F.min("v").alias("low"), F.max("ts").alias("last"),
        F.count_distinct("who").alias("people"), F.count_distinct("v").alias("values"),
        F.array_sort(F.collect_set("who")).alias("names"))
    return grouped.select("window.start", "window.end", *keys, "n", "v", "low", "last", "people", "values", "names")


def from_panes(df, size, slide, keys, **options):
    states = {"n": State(F.count(F.lit(1))), "v": State(F.sum("v")), "low": State(F.min("v"), "min"), "last": State(F.max("ts"), "max"),
              "names": State(F.array_sort(F.collect_set("who")), "set")}
    found = sliding(df, size, slide, keys, states, {"people": "who", "values": "v"}, ts="ts", **options)
    return found.select("window_start", "window_end", *keys, "n", "v", "low", "last", "people", "values", "names")


@pytest.mark.parametrize("size, slide, keys, block", [
    ("10 minutes", "30 seconds", ["k"], 4096), ("10 minutes", "30 seconds", ["k"], 1), ("10 minutes", "4 minutes", [], 3),
    ("1 hour", "20 minutes", ["k"], 2), ("5 minutes", "5 minutes", ["k"], 2)])
def test_panes_equal_repeated_rows(spark, size, slide, keys, block):
    df = events(spark)
    assert rows(from_panes(df, size, slide, keys, block=block)) == rows(plain(df, size, slide, keys))


def test_panes_of_zoned_times_and_other_zones(spark):
    df = events(spark, 100, "timestamp")
    assert rows(from_panes(df, "10 minutes", "1 minute", ["k"])) == rows(plain(df, "10 minutes", "1 minute", ["k"]))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
        df = events(spark, 100)
        back = df.select("ts", from_micros(micros("ts", "timestamp_ntz"), "timestamp_ntz").alias("again"))
        assert back.where("NOT ts <=> again").count() == 0
        assert rows(from_panes(df, "1 hour", "20 minutes", [])) == rows(plain(df, "1 hour", "20 minutes", []))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_panes_of_no_rows_and_wrong_times(spark):
    assert from_panes(events(spark).limit(0), "1 hour", "20 minutes", ["k"]).count() == 0
    with pytest.raises(ValueError):
        sliding(spark.createDataFrame([("x",)], "ts string"), "1 hour", "1 hour", [], {}, ts="ts")


def test_condition_is_tested_before_windows_are_written(spark):
    df = events(spark)
    states = {"n": State(F.count(F.lit(1)))}
    kept = sliding(df, "10 minutes", "30 seconds", ["k"], states, where=F.col("n") >= 5, ts="ts")
    assert rows(kept) == rows(sliding(df, "10 minutes", "30 seconds", ["k"], states, ts="ts").where("n >= 5")) != []


def test_raw_rows_are_not_repeated(spark):
    df = derived.windowed_input(Tables(spark, "/root/testdata/sf0.001"))
    for report in (windows.moving_averages, windows.fraud_windows, windows.velocity_windows, windows.trend_windows):
        assert "Expand" not in report(df)._jdf.queryExecution().executedPlan().toString()


def test_fraud_report_without_listed_values(spark):
    df = derived.windowed_input(Tables(spark, "/root/testdata/sf0.001"))
    wide = {"size": "2 days", "slide": "6 hours"}
    assert rows(windows.fraud_windows(df, **wide)) == rows(windows.fraud_windows(df, **wide, known=derived.KNOWN)) != []


def test_merged_deviation(spark):
    draw = random.Random(2)
    for base in (0, 10 ** 6, 10 ** 8):
        values = [base + draw.randrange(1000) / 100 for _ in range(50)]
        df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("d", F.col("v").cast("decimal(18,4)"))
        got = df.agg(F.count("d").alias("n"), F.sum("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("q"), F.stddev_samp("v").alias("plain")).select(
            sample_deviation("n", "s", "q").alias("made"), "plain").first()
        assert abs(got.made - got.plain) < 1e-6
    one = spark.range(1).select(sample_deviation(F.lit(1), F.lit(5).cast("decimal(28,4)"), F.lit(25).cast("decimal(38,8)")).alias("d")).first()
    assert one.d is None
