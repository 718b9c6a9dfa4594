"""Streams must give what tables give; late rows, restarts and routing."""

import dataclasses
import datetime as dt
import json
import os
import pathlib
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from brightwell.operators import text
from brightwell.session import STREAM_DEFAULTS
from brightwell.sinks import streams as sinks
from brightwell.sources import streams as sources
from brightwell.streaming import combine, decode, latency, patterns, routing, rules, run, state, windows
from tests.conftest import at, rows

ENVELOPE = "key STRING, value STRING, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP"


def message(i, moment, kind="purchase", amount=100.0, account="ACC000001", country="US", channel="online",
            currency="USD", arrival=None):
    value = json.dumps({
        "transaction_id": f"t{i}", "account_id": account, "transaction_type": kind, "amount": amount,
        "currency": currency, "merchant": f"m{i % 3}", "event_time": f"2024-03-01T{moment}",
        "location": {"country": country, "city": "Paris"}, "channel": channel, "status": "completed"})
    return {"key": account, "value": value, "topic": "transactions", "partition": 0, "offset": i,
            "timestamp": f"2024-03-01T{arrival or moment}.000Z"}


def write_files(folder, *batches):
    """One file per batch, each newer than the last."""
    folder = pathlib.Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    done = len(list(folder.glob("*.json")))
    for n, batch in enumerate(batches, done):
        path = folder / f"{n:03d}.json"
        path.write_text("".join(json.dumps(m) + "\n" for m in batch))
        os.utime(path, (1_700_000_000 + n * 10, 1_700_000_000 + n * 10))


MESSAGES = [
    message(i, f"10:{i // 6:02d}:{i * 7 % 60:02d}", kind=("purchase", "transfer", "withdrawal", "deposit")[i % 4],
            amount=[50.0, 1500.0, 7000.0][i % 3], account=f"ACC{i % 5:06d}", country=("US", "CA", "DE")[i % 3],
            channel=("online", "atm", "pos", "mobile")[i % 4], currency=("USD", "EUR", "GBP", "xxx")[i % 4])
    for i in range(120)]
BATCHES = [[m for i, m in enumerate(MESSAGES) if (i * 13) % 4 == b] for b in range(4)]  # out of order


@pytest.fixture()
def feed(spark, tmp_path):
    write_files(tmp_path / "in", *BATCHES)

    def read(streaming):
        if streaming:
            return sources.files(spark, str(tmp_path / "in"), ENVELOPE, max_files=2)
        return spark.read.schema(ENVELOPE).json(str(tmp_path / "in"))
    return read


def enriched(messages, preset="windowed"):
    clock = F.lit("2024-03-01 12:00:00").cast("timestamp")
    df = rules.enrich(decode.transactions(messages), rules.PRESETS[preset], clock)
    return df.withColumn("processing_timestamp", F.col("kafka_timestamp") + F.expr("INTERVAL 3 SECONDS"))


def collect_stream(df, name, mode="complete"):
    run.drain(sinks.to_memory(df, name, mode, trigger=sinks.DRAIN))
    return df.sparkSession.table(name)


REPORTS = {
    "short": windows.short_windows, "mix": windows.mix_windows, "hourly": windows.hourly_windows,
    "business_days": windows.business_days, "basic": windows.basic_windows, "grouped": windows.grouped_windows,
    "channel": windows.channel_windows, "totals": windows.running_totals,
    "moving": windows.moving_averages, "fraud": windows.fraud_windows, "velocity": windows.velocity_windows,
    "trend": windows.trend_windows,
    "account": lambda df: routing.account_summary(df), "statistics": lambda df: routing.type_risk_statistics(df),
    "invalid": lambda df: routing.invalid_monitor(df),
    "delays": lambda df: latency.delay_distribution(latency.add_delays(df)),
    "late": lambda df: latency.late_impact(latency.add_delays(df, late_after=-1)),
    "markets": lambda df: latency.market_hours(df),
    "lateness_type": lambda df: latency.lateness_by_type(latency.add_lateness(df)),
    "lateness_place": lambda df: latency.lateness_by_place(latency.add_lateness(df), "NO_WATERMARK"),
    "lateness_overview": lambda df: latency.lateness_overview(latency.add_lateness(df), "NO_WATERMARK"),
    "lateness_monitor": lambda df: latency.lateness_monitor(latency.add_lateness(df)),
}


@pytest.mark.parametrize("name", REPORTS)
def test_stream_equals_table(feed, name):
    report = REPORTS[name]
    table = report(enriched(feed(False)))
    stream = collect_stream(report(enriched(feed(True))), f"s_{name}")
    assert rows(table) == rows(stream, *table.columns)
    assert table.count() > 0 or name == "invalid"


def test_word_count_stream(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.txt").write_text("to be or not to be\n")
    (tmp_path / "w" / "b.txt").write_text("to do\n")
    lines = sources.files(spark, str(tmp_path / "w"), "value STRING", "text", max_files=1)
    counted = collect_stream(text.raw_word_count(lines, "value"), "s_words", "complete")
    assert dict(rows(counted)) == {"to": 3, "be": 2, "or": 1, "not": 1, "do": 1}


def test_union_of_two_stream_aggregates(feed):
    def report(df):
        return latency.compare_clocks(latency.add_delays(df))
    stream = report(enriched(feed(True)))
    got = {}

    def keep(batch, _):
        got.update({tuple(r)[:2] + (r["aggregation_type"],): tuple(r) for r in batch.collect()})
    run.drain(sinks.each_batch(stream, keep, None, trigger=sinks.DRAIN))
    assert sorted(map(str, got.values())) == sorted(str(tuple(r)) for r in report(enriched(feed(False))).collect())


def test_null_quality_goes_to_invalid(spark):
    bad = [dict(message(1, "10:00:00"), value=json.dumps({
        "transaction_id": "t1", "event_time": "2024-03-01T10:00:00", "amount": None, "location": {"country": None}}))]
    df = spark.createDataFrame([tuple(m.values()) for m in bad], "key STRING, value STRING, topic STRING, partition INT, offset INT, timestamp STRING")
    done = enriched(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")), "detailed")
    routes = routing.route(done)
    assert (routes.valid.count(), routes.invalid.count()) == (0, 1)
    assert routing.invalid_monitor(routes.invalid).first()["invalid_amounts"] == 1


def test_dead_letters(spark):
    good = message(1, "10:00:00")
    data = [tuple(good.values())[:5], ("k", "{broken", "transactions", 0, 2), ("k", None, "transactions", 0, 3),
            ("k", json.dumps({"transaction_id": "t4", "event_time": "yesterday"}), "transactions", 0, 4)]
    df = spark.createDataFrame(data, "key STRING, value STRING, topic STRING, partition INT, offset INT").withColumn(
        "timestamp", F.current_timestamp())
    usable, dead = decode.split_decoded(decode.decode(df))
    assert usable.count() == 1 and rows(dead, "offset") == [(2,), (3,), (4,)]
    assert ("{broken",) in rows(dead, "raw_value")


def test_each_message_is_parsed_once(feed):
    done = routing.route(enriched(feed(False), "detailed")).valid
    assert done._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_rules_in_detail(spark):
    columns = ("transaction_type STRING, amount DOUBLE, currency STRING, country STRING, channel STRING, "
               "account_id STRING, event_timestamp TIMESTAMP")
    sunday, monday = "2024-03-03T03:00:00", "2024-03-04T10:00:00"
    data = [("transfer", 1000.0, "USD", "US", "online", "ACC000001", dt.datetime.fromisoformat(monday)),
            ("transfer", 5000.01, "EUR", "CA", "pos", "ACC000001", dt.datetime.fromisoformat(sunday)),
            ("withdrawal", 20.0, "AUD", "UK", "atm", "acc", dt.datetime.fromisoformat(monday)),
            ("purchase", 100.0, "GBP", "UK", "online", "ACC000001", dt.datetime.fromisoformat(monday)),
            ("purchase", 0.0, "usd", "US", "pos", None, None)]
    df = spark.createDataFrame(data, columns)
    out = rules.enrich(df, rules.DETAILED, F.lit("2024-03-05 10:00:00").cast("timestamp")).collect()
    fees = [float(r["transaction_fee"]) for r in out]
    assert fees == [2.5, 10.0, 2.0, 3.0, 0.0]
    assert [float(r["tax_amount"]) for r in out] == [0, 0, 0, 20.0, 0]
    assert [float(r["amount_usd"]) for r in out] == [1000.0, 5500.011, 13.6, 125.0, 0.0]
    assert float(out[3]["net_amount"]) == 123.0
    assert [r["overall_data_quality"] for r in out] == [True, False, False, True, False]
    # high 25, abroad 20, night or weekend 15, cash 10, online 10, bad quality 30
    assert [r["risk_score"] for r in out] == [20, 100, 60, 30, 30]
    assert [r["risk_level"] for r in out] == ["LOW", "HIGH", "MEDIUM", "LOW", "LOW"]
    basic = rules.enrich(df, rules.BASIC).collect()
    assert [float(r["transaction_fee"]) for r in basic] == [2.5, 5.0, 2.0, 0.0, 0.0]


def test_rate_table_join_on_a_stream(spark, feed):
    rates = spark.createDataFrame([("EUR", 2.0)], "currency STRING, rate DOUBLE")
    got = collect_stream(rules.with_rate_table(decode.transactions(feed(True)), rates).select("transaction_id", "amount_usd"),
                         "s_rates", "append")
    table = rules.with_rate_table(decode.transactions(feed(False)), rates)
    assert rows(got) == rows(table, "transaction_id", "amount_usd") and got.count() == 120


def test_late_rows_are_dropped_only_past_the_watermark(spark, tmp_path):
    late_but_open, too_late = message(90, "10:02:30"), message(91, "10:01:59")
    write_files(tmp_path / "in", [message(1, "10:00:10"), message(2, "10:04:20")],
                [message(3, "10:04:40")],  # watermark: 10:04:10 after the first batch
                [late_but_open, too_late, message(92, "10:04:15")], [message(4, "10:20:00")])
    stream = sources.files(spark, str(tmp_path / "in"), ENVELOPE, max_files=1)
    report = latency.lateness_by_type(latency.add_lateness(enriched(stream)), "STRICT_10s")
    got = collect_stream(report.select("window_start", "transaction_count"), "s_strict", "append")
    # The window of 10:02 closed at 10:04:00, before its late row came.
    assert rows(got) == [(at("10:00:00"), 1), (at("10:04:00"), 3)]
    table = latency.lateness_by_type(latency.add_lateness(enriched(
        spark.read.schema(ENVELOPE).json(str(tmp_path / "in")))), "STRICT_10s")
    assert table.count() == 4
    wide = latency.lateness_by_type(latency.add_lateness(enriched(
        sources.files(spark, str(tmp_path / "in"), ENVELOPE, max_files=1))), "BALANCED_5min")
    kept = collect_stream(wide.select("window_start", "transaction_count"), "s_balanced", "append")
    assert rows(kept) == [(at("10:00:00"), 2), (at("10:02:00"), 1), (at("10:04:00"), 3)]


def test_update_streams_cannot_be_sorted_but_batches_can(feed, tmp_path):
    report = windows.running_totals(enriched(feed(True)))
    with pytest.raises(AnalysisException):
        sinks.to_memory(report.orderBy("total_volume"), "s_sorted", "update", trigger=sinks.DRAIN)
    seen = []
    handler = sinks.sorted_report([F.col("total_volume").desc()], lambda b, i: seen.append(
        [r["total_volume"] for r in b.collect()]))
    run.drain(sinks.each_batch(report, handler, str(tmp_path / "c"), mode="complete", trigger=sinks.DRAIN))
    assert seen and all(batch == sorted(batch, reverse=True) for batch in seen)


def test_file_sinks_restart_without_duplicates(spark, feed, tmp_path):
    def start():
        df = enriched(feed(True), "basic")
        routes = routing.route(df)
        flat = ["transaction_id", "amount", "amount_usd", "country", "risk_score", "risk_level", "event_timestamp"]
        return [
            sinks.to_parquet(routes.valid.select(*flat), str(tmp_path / "valid"), str(tmp_path / "c1"),
                             ["country"], trigger=sinks.DRAIN, name="valid"),
            sinks.to_json(routes.invalid.select("transaction_id", "overall_data_quality"), str(tmp_path / "invalid"),
                          str(tmp_path / "c2"), trigger=sinks.DRAIN, name="invalid"),
            sinks.to_csv(routes.high_risk.select("transaction_id", "risk_level"), str(tmp_path / "high"),
                         str(tmp_path / "c3"), trigger=sinks.DRAIN, name="high")]
    run.drain_all(start())
    write_files(tmp_path / "in", [message(900, "11:00:00", country="US"), message(901, "11:00:00", currency="bad")])
    queries = start()
    run.drain_all(queries)
    table = routing.route(enriched(feed(False), "basic"))
    valid = spark.read.parquet(str(tmp_path / "valid"))
    assert rows(valid, "transaction_id") == rows(table.valid, "transaction_id")
    assert valid.where("transaction_id = 't900'").count() == 1
    assert (tmp_path / "valid" / "country=US").exists()
    assert rows(spark.read.json(str(tmp_path / "invalid")), "transaction_id") == rows(table.invalid, "transaction_id")
    high = spark.read.option("header", True).csv(str(tmp_path / "high"))
    assert rows(high, "transaction_id") == rows(table.high_risk, "transaction_id")


def test_archive_moves_finished_files(spark, tmp_path):
    write_files(tmp_path / "in", *BATCHES)

    def drain():
        df = sources.files(spark, str(tmp_path / "in"), ENVELOPE, max_files=1, archive=str(tmp_path / "done"))
        run.drain(sinks.to_parquet(df, str(tmp_path / "out"), str(tmp_path / "c"), trigger=sinks.DRAIN))
    drain()
    write_files(tmp_path / "in", [message(500, "12:00:00")])
    drain()
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 120
    assert list((tmp_path / "done").rglob("*.json"))


def test_invoice_lines(spark, tmp_path):
    invoice = {"InvoiceNumber": "1", "CreatedTime": 5, "StoreID": "S", "DeliveryAddress": {"City": "Oslo", "PinCode": "9"},
               "InvoiceLineItems": [{"ItemCode": "a", "ItemPrice": 2.5, "ItemQty": 2, "TotalValue": 5.0}, {"ItemCode": "b"}]}
    write_files(tmp_path / "in", [invoice], [{"InvoiceNumber": "2", "InvoiceLineItems": []}, {"InvoiceNumber": "3"}])
    stream = sources.files(spark, str(tmp_path / "in"), decode.INVOICE_DDL)
    flat = collect_stream(decode.invoice_lines(stream), "s_invoices", "append")
    assert rows(flat, "InvoiceNumber", "City", "ItemCode", "TotalValue") == [("1", "Oslo", "a", 5.0), ("1", "Oslo", "b", None)]


@pytest.mark.parametrize("said, missing", [
    ("Table 'shop.totals' doesn't exist", True), ('relation "totals" does not exist', True), ("Table TOTALS not found", True),
    ("java.lang.ClassNotFoundException: org.example.Driver, table driver not found", False), ("column x not found", False)])
def test_only_a_missing_table_counts_as_missing(said, missing):
    assert sinks._table_is_missing(Exception(said)) is missing


def test_messages_for_kafka(feed):
    routes = routing.route(enriched(feed(False), "basic"))
    alert = json.loads(routing.fraud_alerts(routes.high_risk).first()["value"])
    assert set(alert) == {"transaction_id", "account_id", "amount_usd", "risk_score", "risk_level", "country", "alert_time"}
    summary = routing.account_messages(routing.account_summary(routes.valid)).first()
    assert json.loads(summary["value"])["account_id"] == summary["key"]
    assert sinks.kafka_sink_options("h:1", "fraud-alerts") == {"kafka.bootstrap.servers": "h:1", "topic": "fraud-alerts"}


def test_fan_out_survives_a_repeated_batch(spark, feed, tmp_path):
    handle = sinks.fan_out({"valid": lambda b: b.where("overall_data_quality"),
                            "invalid": lambda b: b.where("NOT overall_data_quality")}, str(tmp_path / "out"))
    batch = enriched(feed(False), "basic").select("transaction_id", "overall_data_quality")
    handle(batch, 0)
    handle(batch, 0)
    total = sum(spark.read.parquet(str(tmp_path / "out" / r)).count() for r in ("valid", "invalid"))
    assert total == 120
    run.drain(sinks.each_batch(enriched(feed(True), "basic").select("transaction_id", "overall_data_quality"),
                               sinks.fan_out({"all": lambda b: b}, str(tmp_path / "live")), str(tmp_path / "c"),
                               mode="append", trigger=sinks.DRAIN))
    assert spark.read.parquet(str(tmp_path / "live" / "all")).count() == 120


# Combining ------------------------------------------------------------------------

EVENT = "user STRING, ts TIMESTAMP, kind STRING, id INT"


def events_stream(spark, folder, *batches):
    write_files(folder, *[[{"user": u, "ts": f"2024-03-01T{t}.000Z", "kind": k, "id": i} for u, t, k, i in b]
                          for b in batches])
    return sources.files(spark, str(folder), EVENT, max_files=1)


STORY = [[("a", "10:00:00", "click", 1), ("b", "10:00:00", "click", 2)],
         [("a", "10:10:00", "purchase", 3), ("b", "10:45:00", "purchase", 4), ("a", "10:10:00", "purchase", 3)],
         [("c", "12:00:00", "view", 5)], [("c", "13:30:00", "view", 6)], [("c", "15:30:00", "view", 7)]]


def test_interval_joins(spark, tmp_path):
    def sides():
        stream = events_stream(spark, tmp_path / "in") if (tmp_path / "in").exists() else events_stream(
            spark, tmp_path / "in", *STORY)
        return stream.where("kind = 'click'"), stream.where("kind = 'purchase'")
    left, right = sides()
    inner = combine.join_within(left, right, "user", "ts", "ts", "30 minutes")
    assert rows(collect_stream(inner.select("a.id", "b.right_id"), "s_inner", "append")) == [(1, 3), (1, 3)]
    table = spark.read.schema(EVENT).json(str(tmp_path / "in"))
    batch = combine.join_within(table.where("kind = 'click'"), table.where("kind = 'purchase'"), "user", "ts", "ts", "30 minutes")
    assert rows(batch.select("a.id", "b.right_id")) == [(1, 3), (1, 3)]
    matched = combine.match_sequence(events_stream(spark, tmp_path / "in"), "user", "ts", "kind", "click", "purchase", "1 hour")
    assert rows(collect_stream(matched, "s_match", "append"), "user", "next_ts") == [
        ("a", at("10:10:00")), ("a", at("10:10:00")), ("b", at("10:45:00"))]


@pytest.mark.parametrize("how", ["inner", "left_outer", "right_outer", "full_outer"])
def test_bucketed_interval_join_equals_the_plain_one(spark, how):
    df = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 7 END AS user",
                                     "timestamp_seconds((id * 7919) % 20000) AS ts", "id")
    odd = spark.sql("SELECT CAST(NULL AS BIGINT) AS user, timestamp_seconds(5) AS ts, 900L AS id UNION ALL SELECT 1L, CAST(NULL AS TIMESTAMP), 901L")
    left, right = df.where("id % 2 = 0").union(odd), df.where("id % 2 = 1 OR id % 10 = 0").union(odd)
    got = combine.join_within(left, right, "user", "ts", "ts", "17 minutes", how=how)
    other = right.selectExpr("user AS right_user", "ts AS right_ts", "id AS right_id")
    plain = left.join(other, F.expr("user = right_user AND right_ts BETWEEN ts AND ts + INTERVAL 17 MINUTES"), how)
    assert rows(got, "id", "right_id") == rows(plain, "id", "right_id") and plain.count() > 100


def test_outer_interval_join_emits_the_lonely_rows(spark, tmp_path):
    stream = events_stream(spark, tmp_path / "in", *STORY)
    outer = combine.join_within(stream.where("kind <> 'purchase'"), stream.where("kind = 'purchase' OR kind = 'view'"),
                                "user", "ts", "ts", "30 minutes", how="left_outer")
    got = rows(collect_stream(outer.select("a.id", "b.right_id"), "s_outer", "append"))
    assert (2, None) in got and (1, 3) in got


@pytest.mark.parametrize("how", ["right_outer", "full_outer"])
def test_right_and_full_interval_joins_of_streams(spark, tmp_path, how):
    """Rows of a batch later than the watermark are dropped; the others give what a table gives."""
    late = [("a", "10:20:00", "purchase", 90), ("b", "09:00:00", "click", 91)]
    folder = tmp_path / "in"
    def both(moment, i):  # the watermark follows the slower side
        return [("d", f"{moment}:00", "click", i), ("d", f"{moment}:00", "view", i + 1)]
    stream = events_stream(spark, folder, *STORY, both("20:00", 80), both("20:10", 82), late, both("23:00", 84), both("23:50", 86))
    kinds = ("kind = 'click'", "kind <> 'click'")
    joined = combine.join_within(*[stream.where(k) for k in kinds], "user", "ts", "ts", "30 minutes", "1 minute", how)
    got = rows(collect_stream(joined.select("id", "right_id"), f"s_{how}", "append"))
    table = spark.read.schema(EVENT).json(str(folder)).where("id < 80")
    plain = rows(combine.join_within(*[table.where(k) for k in kinds], "user", "ts", "ts", "30 minutes", how=how).select("id", "right_id"))
    assert [r for r in got if max(v or 0 for v in r) < 80] == plain and not {90, 91} & {v for r in got for v in r}
    assert ({(2, None)} <= set(plain)) == (how == "full_outer") and (1, 3) in plain and (None, 5) in plain


STEPS = [patterns.Step("view", "kind = 'view'"), patterns.Step("click", "kind = 'click' AND id % 3 > 0"), patterns.Step("buy", "kind = 'purchase'")]


def plain_matches(events, steps, span):
    """Matches by a walk over each user's ordered events."""
    tests = {"view": lambda e: e[2] == "view", "click": lambda e: e[2] == "click" and e[3] % 3 > 0, "buy": lambda e: e[2] == "purchase"}
    found = []
    for user in {e[0] for e in events}:
        line = sorted((e for e in events if e[0] == user), key=lambda e: (e[1], e[3]))
        for i, first in enumerate(line):
            run, at = [first], i
            if not tests[steps[0].name](first):
                continue
            for step in steps[1:]:
                later = range(at + 1, min(at + 2, len(line)) if step.strict else len(line))
                at = next((j for j in later if tests[step.name](line[j])), None)
                if at is None:
                    break
                run.append(line[at])
            if len(run) == len(steps) and run[-1][1] <= first[1] + span:
                found.append((user, *[v for e in run for v in (e[1], e[3])]))
    return found


def many_events(n, seed):
    draw = random.Random(seed)
    made = []
    for i in range(n):
        moment = at("06:00:00") + dt.timedelta(seconds=30 * draw.randrange(600))
        made.append((draw.choice("aaab"), moment, draw.choice(["view", "click", "purchase"]), i))
    return made


@pytest.mark.parametrize("strict, slices", [(False, None), (False, 40), (True, None)])
def test_patterns_on_tables_equal_a_plain_walk(spark, strict, slices):
    steps = [*STEPS[:2], dataclasses.replace(STEPS[2], strict=strict)]
    made = many_events(300, 3)
    df = spark.createDataFrame([*made, ("a", None, "view", 900), (None, at("06:00:00"), "view", 901)], "user string, ts timestamp, kind string, id int")
    got = patterns.find(df, "user", "ts", "id", steps, "20 minutes", slices=slices)
    wanted = plain_matches(made, steps, dt.timedelta(minutes=20))
    assert got.columns == ["user", "view_ts", "view_id", "click_ts", "click_id", "buy_ts", "buy_id"]
    assert rows(got) == sorted(wanted, key=lambda r: [(v is None, str(v)) for v in r]) and len(wanted) > 10
    assert patterns.find(df.limit(0), "user", "ts", "id", steps, "1 hour").count() == 0
    with pytest.raises(ValueError):
        patterns.find(df, "user", "ts", "id", [STEPS[0], STEPS[0]], "1 hour")


@pytest.mark.parametrize("strict", [False, True])
def test_patterns_on_streams_replay_in_order(spark, tmp_path, strict):
    steps = [*STEPS[:2], dataclasses.replace(STEPS[2], strict=strict)]
    made = many_events(160, 5)
    random.Random(1).shuffle(made)
    batches = [[(u, t.strftime("%H:%M:%S"), k, i) for u, t, k, i in made[b::4]] for b in range(4)]
    end = [[("z", "23:00:00", "view", 990)], [("z", "23:30:00", "view", 991)], [("a", "07:00:00", "view", 992)]]
    stream = events_stream(spark, tmp_path / "in", *batches, *end)
    found = patterns.find(stream, "user", "ts", "id", steps, "20 minutes", delay="6 hours")
    got = rows(collect_stream(found, f"s_pattern_{strict}", "append"))
    wanted = plain_matches(made, steps, dt.timedelta(minutes=20))
    assert got == sorted(wanted, key=lambda r: [(v is None, str(v)) for v in r]) and len(wanted) > 5


def test_deduplication(spark, tmp_path):
    stream = events_stream(spark, tmp_path / "in", *STORY, [("a", "15:31:00", "purchase", 3)])
    bounded = combine.unique_events(stream, ["user", "id"], "ts", "10 minutes")
    assert rows(collect_stream(bounded.select("id"), "s_unique", "append")) == [(1,), (2,), (3,), (3,), (4,), (5,), (6,), (7,)]
    exact = combine.unique_events(events_stream(spark, tmp_path / "in"), ["user", "id"])
    assert rows(collect_stream(exact.select("id"), "s_exact", "append")) == [(i,) for i in range(1, 8)]


def test_approximate_deduplication(spark, tmp_path):
    days = [[("u", f"{h:02d}:00:00", "view", i) for i in range(40)] for h in (10, 11, 14)]
    stream = events_stream(spark, tmp_path / "in", *days)
    fresh = state.probably_new(stream, ["user", "id"], "ts", keep="2 hours", buckets=4)
    got = collect_stream(fresh, "s_bloom", "append").groupBy("id").count()
    # The second hour repeats the first within two hours; the third comes after it has been forgotten.
    assert rows(got) == [(i, 2) for i in sorted(range(40), key=str)]
    table = spark.read.schema(EVENT).json(str(tmp_path / "in"))
    assert state.probably_new(table, ["user", "id"], "ts", keep="2 hours", buckets=4).count() == 80
    assert state.probably_new(table.limit(0), ["id"], "ts").count() == 0
    crowded = spark.range(4000).selectExpr("'u' AS user", "timestamp'2024-03-01 10:00:00' AS ts", "'v' AS kind", "CAST(id % 2000 AS INT) AS id")
    kept = state.probably_new(crowded, ["id"], "ts", buckets=8, bits=1 << 12, hashes=4)
    assert 1900 <= kept.count() <= 2000 and kept.count() == kept.select("id").distinct().count()


def test_tables_keep_every_new_key(spark):
    many = spark.range(3000).selectExpr("CASE WHEN id % 2 = 0 THEN 'hot' ELSE 'u' END AS user", "CAST(id % 1500 AS INT) AS id",
                                        "timestamp'2024-03-01 10:00:00' + make_interval(0,0,0,0,0,0,id % 7) AS ts")
    kept = state.probably_new(many, ["id"], "ts", buckets=1, bits=1 << 10)
    assert kept.columns == many.columns and kept.count() == 1500
    plan = state.probably_new(many, ["user"], "ts")._jdf.queryExecution().toString()
    assert "Pandas" not in plan and rows(state.probably_new(many, ["user"], "ts").select("user")) == [("hot",), ("u",)]
    odd = spark.createDataFrame([(None, "2024-03-01 10:00:00", 1), (None, "2024-03-01 10:30:00", 2), ("a", None, 3), ("a", None, 4),
                                 (None, "2024-03-01 11:10:00", 5), (None, "2024-03-01 13:10:00", 6)], "user string, ts string, id int")
    fresh = state.probably_new(odd.withColumn("ts", F.col("ts").cast("timestamp")), ["user"], "ts")
    assert rows(fresh.select("id")) == [(1,), (3,), (4,), (6,)]


def test_expected_keys_widen_the_filters(spark, tmp_path):
    crowd = [[("u", f"10:00:{i % 60:02d}", "view", i) for i in range(2000)]]
    stream = events_stream(spark, tmp_path / "in", *crowd)
    fresh = state.probably_new(stream, ["id"], "ts", buckets=1, bits=1 << 12, expected=2000)
    assert collect_stream(fresh, "s_expected", "append").count() >= 1960


def test_sequences_with_a_time_to_live(spark, tmp_path):
    stream = events_stream(spark, tmp_path / "in", *STORY, [("c", "15:40:00", "purchase", 8)])
    found = state.next_within(stream, "user", "ts", "kind", "click", "purchase", "30 minutes")
    query_rows = collect_stream(found, "s_next", "append")
    assert rows(query_rows, "user", "first_ts", "next_ts") == [("a", at("10:00:00"), at("10:10:00"))]


def test_session_windows(spark, tmp_path):
    stream = events_stream(spark, tmp_path / "in", *STORY)
    sessions = combine.session_windows(stream, "user", "ts", "30 minutes", "1 minute")
    got = rows(collect_stream(sessions, "s_sessions", "append"), "user", "session_start", "n_events")
    assert ("a", at("10:00:00"), 3) in got and ("b", at("10:45:00"), 1) in got


def test_merge_watch_and_stop(spark, tmp_path):
    stream = events_stream(spark, tmp_path / "in", *STORY)
    both = combine.merge(stream, stream, tag="origin")
    query = sinks.to_memory(run.observed(both, "seen", "kind = 'view'"), "s_merged", trigger=sinks.DRAIN)
    run.drain(query)
    assert spark.table("s_merged").count() == 16
    assert run.progress(query)["batch_id"] == 4
    assert sum(p["observedMetrics"]["seen"]["rows"] for p in query.recentProgress if p["observedMetrics"]) == 16
    live = sinks.to_memory(events_stream(spark, tmp_path / "in"), "s_live", trigger="1 second")
    assert run.stop_all(spark) == ["s_live"] and not live.isActive


def test_static_join(spark, tmp_path):
    stream = events_stream(spark, tmp_path / "in", *STORY)
    names = spark.createDataFrame([("a", "Ann")], "user STRING, name STRING")
    got = collect_stream(combine.join_static(stream, names, "user").select("id", "name"), "s_static", "append")
    assert rows(got)[0] == (1, "Ann") and (2, None) in rows(got)


def test_state_in_rocksdb(spark, feed):
    settings = {k: v for k, v in STREAM_DEFAULTS.items() if k.startswith("spark.sql.")}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        got = collect_stream(windows.grouped_windows(enriched(feed(True))), "s_rocks")
        table = windows.grouped_windows(enriched(feed(False)))
        assert rows(got) == rows(table)
    finally:
        for key in settings:
            spark.conf.unset(key)
