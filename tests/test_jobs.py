"""Joins, aggregates, text, logs, quality, UDFs, layout, catalogue."""

import collections
import datetime as dt
import os
import re
import string
import time

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from __spark_entry__ import QUERIES
from brightwell.functions import bands, dates, numbers, strings, udfs
from brightwell.operators import aggregate as agg
from brightwell.operators import catalog, layout, logs, quality, skew, text
from brightwell.operators import relational as rel
from brightwell.session import RELEASE, cut_lineage
from brightwell.streaming import windows
from tests.conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Functions -------------------------------------------------------------------

def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_rounding_is_decimal(spark):
    assert one(spark, numbers.round_half_up(F.lit(66.865))) == 66.87
    assert one(spark, numbers.round_half_up(F.lit(-0.125))) == -0.13
    assert one(spark, numbers.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.ratio(F.lit(1), F.lit(4))) == 0.25


def test_dates(spark):
    data = [("04/05/2020", dt.date(2020, 4, 5)), ("4/5/2020", dt.date(2020, 4, 5)), ("2020-04-05", dt.date(2020, 4, 5)),
            ("05-04-2020", dt.date(2020, 4, 5)), ("13/45/2020", None), ("", None), (None, None)]
    df = spark.createDataFrame(data, "t STRING, d DATE")
    assert df.where(~dates.parse_date_any(F.col("t")).eqNullSafe(F.col("d"))).count() == 0
    years = spark.createDataFrame([(6, 2006), (19, 2019), (20, 1920), (81, 1981), (2002, 2002)], "y INT, w INT")
    assert years.where(dates.widen_year(F.col("y")) != F.col("w")).count() == 0
    assert one(spark, dates.date_from_parts(F.lit(2021), F.lit(2), F.lit(30))) is None


def test_people_pipeline(spark):
    """Split birth dates: cast, widen, build the date, drop copies, age, band."""
    raw = spark.createDataFrame([("Mia", "3", "2", "2003"), ("Omar", "14", "9", "79"), ("Lena", "30", "11", "7"),
                                 ("Tove", "2", "4", "58"), ("Omar", "14", "9", "79"), ("Bad", "x", "9", "79")],
                                "name STRING, day STRING, month STRING, year STRING")
    assert rows(rel.find_duplicates(raw, ["name", "day", "month", "year"])) == [("Omar", "14", "9", "79", 2)]
    cast = raw.select("name", *[F.col(c).try_cast("int").alias(c) for c in ("day", "month", "year")])
    dated = cast.select("name", dates.date_from_parts(dates.widen_year(F.col("year")), F.col("month"), F.col("day")).alias("dob"))
    unique = rel.keep_first(dated.withColumn("n", F.lit(1)), ["name", "dob"], ["n"])
    today = F.lit(dt.date(2024, 1, 1))
    profile = unique.select("name", dates.age_in_years(F.col("dob"), today).alias("age"),
                            bands.generation(F.year("dob")).alias("generation"))
    profile = profile.withColumn("stage", bands.life_stage(F.col("age")))
    assert rows(profile) == [("Bad", None, "Silent Generation", "Senior"), ("Lena", 16, "Gen Z", "Minor"),
                             ("Mia", 20, "Gen Z", "Young Adult"), ("Omar", 44, "Gen X", "Adult"),
                             ("Tove", 65, "Baby Boomer", "Senior")]


def test_email_domain(spark):
    data = [(None, "No Email"), ("None", "No Email"), (" ", "No Email"), (" A@Site.ORG ", "site.org"),
            ("a@b@c.d", "c.d"), ("nobody", "Invalid Email")]
    df = spark.createDataFrame(data, "e STRING, d STRING")
    assert df.where(strings.email_domain(F.col("e")) != F.col("d")).count() == 0


def test_category_udf_equals_native_form(spark):
    values = ["F", " female ", "Woman", "femake", "M", "Mal", "male", "msle", "man", "Cis", "", "  ", None, "é", "wxm"]
    df = spark.createDataFrame([(v,) for v in values], "g STRING")
    both = df.select("g", strings.standard_category(F.col("g")).alias("native"), udfs.standard_category_udf("g").alias("udf"))
    assert both.where("NOT native <=> udf").count() == 0
    assert dict(rows(both, "g", "native"))["femake"] == "Female"
    exact = dict(rows(df.select("g", strings.listed_category(F.col("g")))))
    assert exact["femake"] == "Unknown" and exact[" female "] == "Female"


def test_udfs_in_sql(spark):
    assert set(udfs.register_all(spark)) <= set(udfs.registered_functions(spark))
    df = spark.createDataFrame([("17",), ("18",), ("64",), ("65",), ("abc",), (None,)], "a STRING")
    df.createOrReplaceTempView("ages")
    got = spark.sql("SELECT a, age_group_udf(a) FROM ages")
    assert rows(got) == rows(df.select("a", bands.age_group(F.col("a"))))


def test_quality_grade(spark):
    df = spark.createDataFrame([("F", 30, "US"), ("", 30, "US"), (None, None, "US"), ("M", 150, "U"), ("M", 119, None)],
                               "g STRING, a INT, c STRING")
    grades = [r[0] for r in df.select(udfs.quality_grade(F.col("g"), F.col("a"), F.col("c"))).collect()]
    assert grades == ["Excellent", "Fair", "Poor", "Poor", "Fair"]


# Joins and sets ----------------------------------------------------------------

def test_left_join_defaults(spark):
    orders = spark.createDataFrame([("A1", "P7", 12), ("A2", "P9", 30)], "order_id STRING, prod_id STRING, price INT")
    products = spark.createDataFrame([("P7", "Lamp", 15), ("P8", "Desk", 1)], "prod_id STRING, prod_name STRING, list_price INT")
    report = rel.left_join_defaults(orders, products, "prod_id", {"prod_name": "NA", "list_price": 0})
    assert rows(report, "order_id", "prod_name", "list_price") == [("A1", "Lamp", 15), ("A2", "NA", 0)]


def test_broadcast_depends_on_bytes(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(50).selectExpr("id AS d", "id * 2 AS v")
    small = rel.lookup(big, dim, "k", "d", {"v": "v"})
    assert "BroadcastHashJoin" in plan_of(small)
    found = rows(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = rel.lookup(big, dim, "k", "d", {"v": "v"})
        assert "SortMergeJoin" in plan_of(large) and rows(large) == found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_hop_drops_the_way_back(spark):
    edges = spark.createDataFrame([("1", "2"), ("2", "1"), ("2", "3"), ("1", "3"), ("3", "4"), ("1", "2")], "src STRING, dst STRING")
    assert rows(rel.two_hop(edges)) == [("1", "3"), ("1", "4"), ("2", "3"), ("2", "4")]


def test_unions(spark):
    a, b = spark.createDataFrame([(1,), (1,)], "x INT"), spark.createDataFrame([(1, 2)], "x INT, y INT")
    assert rows(rel.union_all(a, b, allow_missing=True)) == [(1, 2), (1, None), (1, None)]
    assert rows(rel.union_distinct(a, b.select("x"))) == [(1,)]


def test_metric_rows_scan_once(spark):
    df = spark.range(10)
    metrics = rel.metric_rows(df, {"rows": F.count(F.lit(1)), "even": F.count_if(F.col("id") % 2 == 0)})
    assert rows(metrics) == [("even", 5), ("rows", 10)]
    assert "Union" not in plan_of(metrics)


# Aggregates ---------------------------------------------------------------------

def test_rollup_tells_null_from_total(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "x", 4)], "k STRING, m STRING, v LONG")
    report = agg.rollup_report(df, ["k", "m"], {"s": F.sum("v")}, {"k": "ALL", "m": "all"})
    assert rows(report) == [("ALL", "all", 3, 7), ("a", "all", 1, 3), ("a", "x", 0, 1), ("a", None, 0, 2),
                            (None, "all", 1, 4), (None, "x", 0, 4)]
    ordered_levels = [r["level"] for r in agg.subtotals_last(report, ["k", "m"]).collect()]
    assert ordered_levels[-1] == 3 and ordered_levels[0] == 0


def test_hub_mean_is_weighted(spark):
    out = spark.createDataFrame([("A", 10.0), ("A", 20.0), ("A", 30.0)], "hub STRING, d DOUBLE")
    back = spark.createDataFrame([("A", 100.0), ("B", None)], "hub STRING, d DOUBLE")
    assert rows(agg.hub_activity(out, back, "hub", "d")) == [("A", 3, 1, 4, 40.0), ("B", 0, 1, 1, None)]


def test_completion_and_sums_are_exact(spark):
    todos = spark.createDataFrame([(1, True), (1, True), (1, False), (2, None)], "user INT, done BOOLEAN")
    assert [(u, n, d, float(r)) for u, n, d, r in rows(agg.completion_rates(todos, ["user"], F.col("done")))] == [
        (1, 3, 2, 66.67), (2, 1, 0, 0.0)]
    cents = spark.createDataFrame([(0.1,)] * 10, "v DOUBLE").select(numbers.total(numbers.money("v")).alias("t"))
    assert cents.first()["t"] == 1.0


def test_no_sketch_for_every_user(spark):
    plan = plan_of(QUERIES["agg_approx_distinct"](spark, "/root/testdata/sf0.001"))
    kept = [line for line in plan.splitlines() if "Aggregate(" in line and "approx_count_distinct" in line]
    assert kept and not [line for line in kept if "user_id" in line.split("functions=")[0]]


@pytest.mark.parametrize("name", ["product_matrix", "customer_value"])
def test_pairs_are_dealt_before_they_are_grouped(spark, name):
    """Groups of a few rows each must not be gathered by the task that reads a file."""
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    pairs = re.findall(r"hashpartitioning\((\w+)#\d+L?, (\w+)#\d+L?, \d+\), REPARTITION_BY_NUM", plan)
    assert len(set(pairs)) == 2 and {"p_partkey", "o_custkey"} & set(pairs[0])
    rows_a_task = spark.range(5 * agg.TASK_ROWS + 1)
    assert agg.tasks_for(rows_a_task) == 6 and agg.tasks_for(spark.range(0)) == spark.sparkContext.defaultParallelism


def test_routes_are_dealt_before_they_are_grouped(spark):
    df = spark.range(4000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id = 1 THEN NULL ELSE id % 700 END AS o", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 7 END AS d",
        "nullif(id % 5, 4) AS c", "id % 2 = 0 AS off", "CAST(nullif(id % 11, 3) AS DOUBLE) AS km")
    found = agg.route_performance(df, "o", "d", "c", F.col("off"), "km", 2, 3)
    wanted = df.groupBy("o", "d").agg(
        F.count(F.lit(1)).alias("flight_count"), F.count_distinct("c").alias("carriers_serving"),
        numbers.mean(numbers.money("km")).alias("avg_distance"), F.count_if("off").alias("cancelled_count")).where("flight_count >= 2")
    assert found.dtypes == wanted.dtypes and rows(found) == rows(wanted) and wanted.count() > 500
    plan = plan_of(QUERIES["route_performance"](spark, "/root/testdata/sf0.001"))
    assert re.search(r"l_suppkey#\d+L?, l_partkey#\d+L?, l_linestatus#\d+, __salt#\d+, \d+\), REPARTITION_BY_NUM", plan)
    assert re.search(r"\(l_suppkey#\d+L?, l_partkey#\d+L?, \d+\), REPARTITION_BY_NUM", plan)


def test_approximate_distinct_is_close(spark):
    df = spark.range(100_000)
    estimate = df.agg(F.approx_count_distinct("id", 0.02).alias("n")).first()["n"]
    assert abs(estimate - 100_000) <= 100_000 * 0.06


def test_first_totals_count_few_accounts_of_many_windows(spark):
    """Two pairs of four accounts meet in a register of a plain sketch in groups 2379 and 36140."""
    ids = spark.range(160_000).select((F.col("id") / 4).cast("long").alias("minute"), F.concat(
        F.lit("ACC"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("account_id"))
    totals = ids.where("minute IN (2379, 36140)").unionByName(spark.createDataFrame(
        [(1, None), (1, None), (2, ""), (2, "a"), (2, "a")], "minute LONG, account_id STRING"))
    totals = totals.select("account_id", F.timestamp_seconds(F.col("minute") * 60).alias("event_timestamp"), F.lit(1).cast("decimal(18,2)").alias("amount_usd"))
    found = windows.basic_windows(totals)
    assert rows(found, (F.unix_timestamp("window_start") / 60).cast("int"), "unique_accounts", "total_transactions") == [
        (1, 0, 2), (2, 2, 3), (2379, 4, 4), (36140, 4, 4)]
    many = spark.range(400_000).select((F.col("id") % 200).alias("g"), F.col("id").cast("string").alias("a"))
    far = many.groupBy("g").agg(agg.sketched_count("a").alias("n")).where("abs(n - 2000) > 0.15 * 2000")
    assert far.count() == 0


def test_salted_jobs_equal_plain_jobs(spark):
    large = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 200 END AS k", "id")
    other = spark.range(150).selectExpr("id AS k", "id * 10 AS w")
    for how in ("inner", "left"):
        assert rows(skew.salted_join(large, other, "k", 4, how=how), "k", "id", "w") == rows(
            large.join(other, "k", how), "k", "id", "w")
    assert rows(skew.hot_keys(large, ["k"], 0.1)) == [(0,)]
    gaps = large.selectExpr("nullif(k, 0) AS k", "CAST(id % 2 AS STRING) AS half", "id")
    pairs = gaps.groupBy("k", "half").agg(F.count(F.lit(1)).alias("n"))
    same = [gaps["k"].eqNullSafe(pairs["k"]), gaps["half"] == pairs["half"]]
    assert rows(skew.attach(gaps, pairs, ["k", "half"])) == rows(gaps.join(pairs, same, "left").select(gaps["*"], "n"))
    assert skew.attach(gaps, pairs, ["k", "half"]).where("n IS NULL").count() == 0
    plain = skew.salted_join(gaps, pairs.drop("half"), "k", how="left")
    assert plain.where("k IS NULL AND n IS NOT NULL").count() == 0
    salted = skew.salted_aggregate(large, ["k"], {"s": F.sum("id"), "n": F.count(F.lit(1))},
                                   {"s": F.sum("s"), "n": F.sum("n")}, 8)
    assert rows(salted) == rows(large.groupBy("k").agg(F.sum("id"), F.count(F.lit(1))))


def test_listed_values_are_counted_by_masks(spark):
    df = spark.range(600).selectExpr("id % 3 AS k", "CASE WHEN id % 7 = 0 THEN NULL ELSE 'v' || (id % 5) END AS few",
                                     "'m' || (id % 101) AS many", "CAST(NULL AS STRING) AS none")
    known = {"few": [f"v{i}" for i in range(5)], "many": [f"m{i}" for i in range(101)], "none": None}
    wanted = {c: F.count_distinct(c).alias(c) for c in known}
    got = df.groupBy("k").agg(*[agg.few_distinct(df, c, v).alias(c) for c, v in known.items()])
    assert rows(got) == rows(df.groupBy("k").agg(*wanted.values()))
    masks = {f"m{i}": m for i, m in enumerate(agg.value_masks("many", known["many"]))}
    assert len(masks) == 2
    listed = df.where("id IN (1, 64, 100, 101)").agg(*[m.alias(n) for n, m in masks.items()]).select(
        agg.masked_values([F.col(n) for n in masks], known["many"]).alias("v"))
    assert listed.first()["v"] == ["m0", "m1", "m64", "m100"]
    with pytest.raises(Exception, match="not listed"):
        df.agg(agg.few_distinct(df, "few", ["v0", "v1"])).collect()


def test_percentiles_are_exact_in_large_groups(spark):
    df = spark.range(60_000).selectExpr("id % 2 AS k", "CAST((id * 7919) % 59999 - 20000 AS DOUBLE) / 7 AS v").union(
        spark.createDataFrame([(None, 1.5), (None, None), (5, None)], "k long, v double"))
    points = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["k"]: tuple(r)[1:] for r in agg.percentiles(df, ["k"], "v", points).collect()}
    values = {0: [], 1: []}
    for r in df.where("k < 2").collect():
        values[r["k"]].append(r["v"])
    for k, v in values.items():
        v.sort()
        assert got[k] == tuple(v[max(-(-int(p * 100) * len(v) // 100), 1) - 1] for p in points.values())
    assert got[None] == (1.5,) * 5 and got[5] == (None,) * 5
    assert agg.percentiles(df.limit(0), ["k"], "v", points).count() == 0


def test_equal_rows_fill_all_salts(spark):
    equal = spark.range(0, 10_000, 1, 64).selectExpr("1 AS k", "'x' AS v").union(spark.createDataFrame([(2, "y")], "k INT, v STRING"))
    assert skew.with_salt(equal, 16).where("k = 1").groupBy("__salt").count().count() == 16
    other = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, w STRING")
    joined = skew.salted_join(equal, other, "k")
    assert rows(joined.groupBy("k", "v", "w").count()) == [(1, "x", "a", 10_000), (2, "y", "b", 1)]
    for find in (skew.hot_keys, skew.hot_hashes):
        with pytest.raises(ValueError):
            find(equal, ["k"], 1e-9)
    # A repeated task gives the same salts; nothing is written for the join.
    assert rows(skew.with_salt(equal, 16)) == rows(skew.with_salt(equal, 16))
    assert "Scan ExistingRDD" not in skew.salted_join(spark.range(100).withColumnRenamed("id", "k"), spark.range(9).selectExpr("id AS k", "1 AS w"), "k")._jdf.queryExecution(
        ).executedPlan().toString().replace("Scan ExistingRDD[__hot", "")


def test_frequent_keys_are_found_in_one_pass(spark):
    df = spark.range(100_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 50 = 1 THEN 'b' WHEN id % 500 = 2 THEN 'c' ELSE 'k' || id END AS k",
                                         "id % 2 AS j")
    hashes = {k: df.sparkSession.range(1).select(F.xxhash64(F.lit(k))).first()[0] for k in "abc"}
    found = {r[0] for r in skew.hot_hashes(df, ["k"], 0.01).collect()}
    assert hashes["a"] in found and hashes["b"] in found and hashes["c"] not in found and len(found) <= 200
    assert skew.hot_hashes(df.limit(0), ["k"]).count() == 0 and skew.hot_hashes(df, ["k", "j"]).count() >= 3
    maps = df.selectExpr("k", "map('x', j) AS m").limit(10)
    assert skew.with_salt(maps, 4).count() == 10


# Text and logs --------------------------------------------------------------------

LINES = ["Spark is fast, Spark is fun!", "", "  Été d'été -- (spark) 2x", "one"]


def test_text_against_python(spark):
    df = spark.createDataFrame([("\n".join(LINES),), (None,)], "t STRING")
    cleaned = [w.strip(string.punctuation).lower() for line in LINES for w in line.split()]
    cleaned = [w for w in cleaned if w and w.isalpha()]
    counts = collections.Counter(cleaned)
    assert dict(rows(text.word_count(df, "t"))) == counts
    stats = text.corpus_statistics(df, "t").first()
    assert stats["total_words"] == len(cleaned) and stats["unique_words"] == len(counts)
    assert stats["longest_word"] == min(counts, key=lambda w: (-len(w), w))
    assert stats["shortest_word"] == min(counts, key=lambda w: (len(w), w))
    assert dict(rows(text.word_lengths(df, "t"))) == collections.Counter(map(len, cleaned))
    pairs = collections.Counter()
    for line in LINES:
        ws = [w.lower() for w in line.split()]
        pairs.update(zip(ws, ws[1:]))
    assert {(a, b): n for a, b, n in rows(text.bigrams(df, "t"))} == pairs
    assert rows(text.words_containing(df, "t", "spark")) == [("spark", 3)]


LOG = [
    '1.2.3.4 - - [10/Oct/2023:13:55:36 +0200] "GET /a HTTP/1.1" 200 12 "http://x.org/p?q" "Mozilla Chrome/1 Edg/2"',
    '1.2.3.4 - bob [10/Oct/2023:14:55:36 +0000] "POST /login HTTP/1.1" 404 - "" "Mozilla (Linux; Android) Chrome/1"',
    '::1 - - [bad] "GET /a HTTP/1.1" 200 12 "-" "curl"',
    '5.6.7.8 - - [10/Oct/2023:14:55:36 +0000] "GET /../x HTTP/1.1" 503 99999999999 "https://www.google.com/q" "crawler bot"',
    "nonsense",
]


def test_log_analysis(spark):
    parsed = logs.parse_log(spark.createDataFrame([(v,) for v in LOG], "value STRING")).cache()
    report = logs.parse_report(parsed).first()
    assert (report["total_records"], report["parsed_records"], report["success_rate"]) == (5, 3, 60.0)
    assert dict(rows(logs.by_browser(parsed)))["Edge"] == 1
    assert dict(rows(logs.by_browser(parsed, logs.BROWSERS_GENERAL_FIRST)))["Chrome"] == 2
    assert dict(rows(logs.by_system(parsed)))["Android"] == 1
    assert dict(rows(logs.by_system(parsed, logs.SYSTEMS_GENERAL_FIRST)))["Linux"] == 1
    timed = logs.with_log_time(parsed)
    assert rows(logs.hourly_traffic(timed, "parsed_timestamp")) == [(11, 1), (14, 2)]
    assert rows(logs.weekday_traffic(timed, "parsed_timestamp")) == [("Tuesday", 3, 3)]
    assert rows(logs.error_endpoints(parsed)) == [("404", "/login", 1), ("503", "/../x", 1)]
    assert rows(logs.referrers(parsed)) == [("Other Website", "http://x.org", 1), ("Search Engine", "https://www.google.com", 1)]
    assert rows(logs.response_sizes(parsed), "status", "total_bytes") == [("200", 12), ("503", 99999999999)]
    assert rows(logs.suspicious(parsed)) == [("/../x", "503", 1), ("/login", "404", 1)]
    assert dict((r[0], r[2]) for r in rows(logs.by_status(parsed)))["503"] == "Server Error"
    groups = re.match(logs.LOG_PATTERN, LOG[0])
    assert len(groups.groups()) == 11


# Quality ---------------------------------------------------------------------------

def test_quality_reports(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2020, 1, 1)), (2, " ", None), (None, None, None)], "id INT, name STRING, d DATE")
    profile = quality.null_profile(df, ["id"], F.col("name") == "a", "d").first()
    assert (profile["null_id"], profile["event_count"], profile["null_dates"], profile["max_date"]) == (1, 1, 2, dt.date(2020, 1, 1))
    assert rows(quality.rule_violations(df, {"No id": F.col("id").isNull(), "Big": F.col("id") > 1})) == [
        ("Big", 1), ("No id", 1), ("Total Records", 3)]
    assert rows(quality.completeness(df, ["id", "d"])) == [("d", 3, 1, 33.33), ("id", 3, 2, 66.67)]
    assert [r[0] for r in df.select(quality.row_score(["id", "name", "d"])).collect()] == [100.0, 33.33, 0.0]
    assert rows(quality.status_counts(df, [(F.col("id") > 1, "Big"), (F.col("d").isNull(), "No date")])) == [
        ("Big", 1), ("No date", 1), ("Valid", 1)]
    assert quality.parse_rate(df, F.col("d")).first()["success_rate"] == 33.33
    assert rows(quality.reconcile(df, ["name"], F.sum("id"), F.sum("id") + 0)) == [("Match", 3)]
    empty = df.limit(0)
    assert quality.null_profile(empty, ["id"], F.col("id") > 0).first()["event_rate"] is None
    assert rows(quality.completeness(empty, ["id"])) == [("id", 0, 0, None)]


# Layout and catalogue ------------------------------------------------------------------

def test_partition_report(spark):
    df = spark.range(0, 100, 1, 4).where("id < 60")
    report = layout.skew_report(df, 4).first()
    assert (report["empty_partitions"], report["max_rows"], report["min_rows"], report["is_skewed"]) == (1, 25, 0, True)
    even = layout.spread(spark.range(100), 4)
    assert not layout.skew_report(even, 4).first()["is_skewed"]
    assert layout.narrow(even, 2).rdd.getNumPartitions() == 2
    assert rows(layout.key_cardinality(spark.range(4).selectExpr("id % 2 AS k"), "k")) == [(0, 2), (1, 2)]


def test_cache_is_released_and_sits_above_the_filter(spark):
    df = spark.range(1000).where("id > 500")
    with layout.cached(df) as held:
        assert held.count() == 499 and layout.cache_status(held)["is_cached"]
        assert "InMemoryRelation" in plan_of(held.groupBy((F.col("id") % 2).alias("k")).count())
    assert not layout.cache_status(df)["is_cached"]
    with layout.cached(spark.range(5), StorageLevel.DISK_ONLY) as disk:
        assert layout.cache_status(disk) == {"is_cached": True, "use_memory": False, "use_disk": True}
    assert "== Physical Plan ==" in layout.plan_text(df)


def test_bucketed_table_needs_no_shuffle(spark):
    catalog.use_database(spark, "bw_test")
    df = spark.range(1000).selectExpr("id % 20 AS carrier", "id AS flight")
    catalog.save_bucketed(df, "flights", ["carrier"], 5, ["carrier"])
    catalog.save_bucketed(df.groupBy("carrier").count(), "carriers", ["carrier"], 5, ["carrier"])
    counts = catalog.read_table(spark, "flights").groupBy("carrier").count()
    assert "Exchange" not in plan_of(counts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = catalog.read_table(spark, "flights").join(catalog.read_table_sql(spark, "carriers"), "carrier")
        assert "Exchange" not in plan_of(joined) and joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "bw_test" in catalog.databases(spark) and catalog.tables(spark) == ["carriers", "flights"]
    described = {r["col_name"]: r["data_type"] for r in catalog.describe(spark, "flights").collect()}
    assert described["Num Buckets"] == "5"
    assert catalog.properties(spark, "flights").count() >= 0
    catalog.cache_table(spark, "flights")
    assert spark.catalog.isCached("flights")
    catalog.uncache_table(spark, "flights")
    assert not spark.catalog.isCached("flights")
    catalog.refresh_table(spark, "flights")
    catalog.analyze_table(spark, "flights", ["carrier"])
    statistics = [r["data_type"] for r in catalog.describe(spark, "flights").collect() if r["col_name"] == "Statistics"]
    assert "1000 rows" in statistics[0]
    assert {r["tableName"] for r in catalog.shown_tables(spark).collect()} == {"carriers", "flights"}
    catalog.save_partitioned(df, "by_carrier", ["carrier"])
    assert catalog.read_table(spark, "by_carrier").where("carrier = 3").count() == 50
    catalog.save_plain(df, "plain")
    assert catalog.read_table(spark, "plain").count() == 1000
    catalog.drop_table(spark, "plain")
    spark.catalog.setCurrentDatabase("default")
    catalog.drop_database(spark, "bw_test")
    assert "bw_test" not in catalog.databases(spark)


def test_views(spark):
    catalog.as_view(spark.range(3), "bw_numbers")
    assert catalog.view_from_sql(spark, "bw_big", "SELECT id FROM bw_numbers WHERE id > 0").count() == 2


def test_filters_and_columns_reach_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    report = lines.where(F.col("l_quantity") > 30).groupBy("l_returnflag").count()
    plan = plan_of(report)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,30.0)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan
    assert "SinglePartition" not in plan
    with pytest.raises(ValueError):
        skew.salted_join(lines, lines, "l_orderkey", how="full")


def shuffle_files(spark):
    """Files that shuffles have left on this machine."""
    tops = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_shuffle_files_go_with_their_checkpoint(spark):
    """They must not pile up over the rounds of a loop until the driver collects its garbage."""
    before, setting = shuffle_files(spark), spark.conf.get(RELEASE)
    df = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    most = df.groupBy("k").agg(F.max("v").alias("v"))
    held = [cut_lineage(most.join(df.groupBy("k").agg(F.min("v").alias("w")), "k").withColumn("n", F.lit(n))) for n in range(3)]
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(RELEASE) == setting
    # What was cut, and what it came from, can be read again and again.
    for _ in range(2):
        assert [rows(h) for h in held] == [sorted((k, 990 + k, k, n) for k in range(10)) for n in range(3)]
        assert rows(most) == [(k, 990 + k) for k in range(10)]
