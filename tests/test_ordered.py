"""Sliced windows must equal plain Spark windows, whatever the skew."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brightwell.operators import ordered
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 31 == 0 else f"k{rng.randrange(40)}")
        value = None if rng.random() < 0.2 else rng.randrange(100)
        data.append((key, rng.randrange(50), i, value))
    return spark.createDataFrame(data, "key STRING, ts INT, id INT, value LONG").repartition(5).cache()


def order_of(kind):
    return ["ts", "id"] if kind == "asc" else [F.col("ts").desc(), F.col("id")]


@pytest.mark.parametrize("kind", ["asc", "desc"])
@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("slices", [1, 3, 17])
def test_sliced_equals_plain(skewed, kind, keys, slices):
    order = order_of(kind)
    wanted = ordered.Wanted("rn", {"total": "value"}, {"before": "value"}, {"after": "value"})
    got = ordered.ordered_columns(skewed, order, wanted, keys, slices=slices)
    w = Window.partitionBy(*keys).orderBy(*order)
    plain = skewed.withColumns({
        "rn": F.row_number().over(w).cast("long"),
        "total": F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "before": F.lag("value").over(w), "after": F.lead("value").over(w)})
    assert rows(got) == rows(plain)
    assert got.columns == plain.columns


def test_global_row_number_has_no_single_task_window(skewed):
    numbered = ordered.row_numbers(skewed.select("ts", "id"), ["ts", "id"])
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
    expected = skewed.select("ts", "id", F.row_number().over(Window.orderBy("ts", "id")).cast("long").alias("row_number"))
    assert rows(numbered) == rows(expected)


@pytest.mark.parametrize("slices", [None, 5])
def test_moving_sum_share_and_ranks(skewed, slices):
    w = Window.partitionBy("key").orderBy("ts", "id")
    moving = ordered.moving_sum_of_two(skewed, "value", ["ts", "id"], ["key"], slices=slices)
    assert rows(moving) == rows(skewed.withColumn("moving_sum", F.sum("value").over(w.rowsBetween(-1, 0))))
    ranked = ordered.ranks(skewed, "ts", ["key"], slices=slices)
    by = Window.partitionBy("key").orderBy(F.col("ts").desc())
    plain = skewed.withColumns({"rank": F.rank().over(by).cast("long"), "dense_rank": F.dense_rank().over(by).cast("long")})
    assert rows(ranked) == rows(plain)


def test_share_of_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "key STRING, value LONG")
    shared = ordered.share_of_group(df, "value", ["key"])
    assert rows(shared) == [("a", 1, 4, 25.0), ("a", 3, 4, 75.0), (None, 5, 5, 100.0)]


def test_running_sum_keeps_leading_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 4), (4, None), (5, 1)], "id INT, value LONG")
    summed = ordered.running_sum(df, "value", ["id"], slices=3)
    assert [r["running_total"] for r in summed.orderBy("id").collect()] == [None, None, 4, 4, 5]


def test_empty_table(spark):
    df = spark.createDataFrame([], "key STRING, id INT")
    assert ordered.row_numbers(df, ["id"], ["key"]).count() == 0
    assert ordered.row_numbers(df, ["id"]).count() == 0


@pytest.mark.parametrize("slices", [None, 9])
def test_sessions_and_sequences(skewed, slices):
    df = skewed.selectExpr("coalesce(key, '-') AS key", "timestamp_seconds(ts * 60) AS ts", "id",
                           "CASE id % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'purchase' ELSE 'view' END AS kind")
    data = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1], r[2]))
    expected_sessions, expected_pairs, last, number = [], [], {}, {}
    for key, ts, i, kind in data:
        if key not in last or (ts - last[key][0]).total_seconds() >= 180:
            number[key] = number.get(key, 0) + 1
        if key in last and last[key][2] == "click" and kind == "purchase" and (ts - last[key][0]).total_seconds() <= 60:
            expected_pairs.append((key, last[key][1]))
        expected_sessions.append((key, i, number[key]))
        last[key] = (ts, i, kind)
    got = ordered.sessions(df, "key", "ts", "3 MINUTES", "id", slices=slices)
    assert rows(got, "key", "id", "session_number") == sorted(expected_sessions, key=lambda r: [(False, str(v)) for v in r])
    pairs = ordered.followed_by(df, "key", "ts", "kind", "click", "purchase", "1 MINUTE", "id", slices=slices)
    assert rows(pairs, "key", "id") == sorted(expected_pairs, key=lambda r: [(False, str(v)) for v in r])
