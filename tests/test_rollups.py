"""Stored partial states: increments in any split give the full run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brightwell.operators.rollups import DISTINCT_ERROR, Metric, Rollup
from tests.conftest import rows

EXACT = {"n": Metric("count"), "filled": Metric("count", "v"), "total": Metric("sum", "v"), "low": Metric("min", "v"), "high": Metric("max", "v"),
         "users": Metric("distinct", "user")}
KEYS = ["kind", "day"]


def events(spark, n=400, seed=1):
    draw = random.Random(seed)
    return spark.createDataFrame([(
        i, draw.choice(["a", "b", None]), dt.date(2024, 1, draw.randrange(1, 32)), draw.choice([None, *range(20)]), draw.randrange(30)) for i in range(n)],
        "id long, kind string, day date, v int, user int")


def plain(df, keys=KEYS):
    grouped = df.groupBy(*keys)
    return rows(grouped.agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("filled"), F.sum("v").alias("total"), F.min("v").alias("low"),
                            F.max("v").alias("high"), F.count_distinct("user").alias("users")))


@pytest.mark.parametrize("split", [[400], [100, 250, 400], [1, 399, 400]])
def test_increments_in_any_split_equal_the_full_run(spark, tmp_path, split):
    df, kept, before = events(spark), Rollup(spark, str(tmp_path / "r"), KEYS, EXACT), 0
    assert kept.mark() is None
    with pytest.raises(ValueError):
        kept.read()
    for number, upto in enumerate(split):
        assert kept.apply(number, df.where(f"id >= {before} AND id < {upto}"))
        before = upto
        if number == 1:
            kept.compact()
    assert rows(kept.read()) == plain(df) and kept.mark() == len(split) - 1
    assert not kept.apply(0, df) and rows(kept.read()) == plain(df)
    assert rows(kept.read(["kind"])) == plain(df, ["kind"]) and rows(kept.read([])) == plain(df, [])
    week = F.date_trunc("week", "day")
    assert rows(kept.read(["week"], {"week": week})) == plain(df.withColumn("week", week), ["week"])


def test_corrections_are_taken_back(spark, tmp_path):
    df = events(spark)
    wrong = df.where("id % 3 = 0").withColumns({"v": F.lit(99), "user": F.lit(-1), "day": F.lit(dt.date(2025, 5, 5))})
    kept = Rollup(spark, str(tmp_path / "r"), KEYS, EXACT)
    kept.apply(1, df.where("id % 3 <> 0").unionByName(wrong))
    assert rows(kept.read()) != plain(df)
    kept.apply(2, df.where("id % 3 = 0"), retracted=wrong)
    assert rows(kept.read()) == plain(df)
    kept.compact()
    kept.compact()
    assert rows(kept.read()) == plain(df)
    kept.apply(3, df.limit(0), retracted=df)
    assert kept.read().count() == 0
    sketched = Rollup(spark, str(tmp_path / "s"), KEYS, {"u": Metric("approx_distinct", "user")})
    with pytest.raises(ValueError):
        sketched.apply(1, df, retracted=df)
    with pytest.raises(ValueError):
        Rollup(spark, str(tmp_path / "t"), KEYS, {"u": Metric("mode", "user")})


def test_a_write_without_commit_is_not_read(spark, tmp_path, monkeypatch):
    df, kept = events(spark), Rollup(spark, str(tmp_path / "r"), KEYS, EXACT)
    kept.apply(1, df.where("id < 200"))
    def broken(self, kind, number):
        raise RuntimeError("lost")
    with monkeypatch.context() as patched:
        patched.setattr(Rollup, "_commit", broken)
        for change in (lambda: kept.apply(2, df.where("id >= 100")), kept.compact):
            with pytest.raises(RuntimeError):
                change()
    assert rows(kept.read()) == plain(df.where("id < 200")) and kept.mark() == 1
    again = Rollup(spark, str(tmp_path / "r"), KEYS, EXACT)
    again.apply(2, df.where("id >= 200"))
    assert rows(again.read()) == plain(df)


def test_advance_takes_what_lies_beyond_the_mark(spark, tmp_path):
    df, kept = events(spark), Rollup(spark, str(tmp_path / "r"), KEYS, EXACT)
    assert not kept.advance(df.limit(0), "id")
    for upto in (150, 150, 151, 400, 400):
        kept.advance(df.where(f"id < {upto}"), "id")
    assert rows(kept.read()) == plain(df) and kept.mark() == 399
    assert not kept.advance(df, "id")


def test_sketches_merge_over_panes_and_increments(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id", "id % 30 AS day", "(id * 7919) % 20011 AS user", "CAST((id * 31) % 60000 AS DOUBLE) AS v")
    metrics = {"users": Metric("approx_distinct", "user"), "median": Metric("approx_quantile", "v"), "p99": Metric("approx_quantile", "v", 0.99),
               "low": Metric("running_min", "v"), "high": Metric("running_max", "v")}
    kept = Rollup(spark, str(tmp_path / "r"), ["day"], metrics)
    for number in range(3):
        kept.apply(number, df.where(f"id % 3 = {number}"))
    for keys, users in ((["day"], 2000), ([], 20011)):
        for r in kept.read(keys).collect():
            exact = df.where(f"day = {r.day}") if keys else df
            assert abs(r.users - exact.select("user").distinct().count()) <= 3 * DISTINCT_ERROR * users + 1
            assert abs(r.median - 30_000) < 0.03 * 60_000 and abs(r.p99 - 59_400) < 0.02 * 60_000 and r.low < 31 and r.high > 59_900
            if keys and r.day > 2:
                break
