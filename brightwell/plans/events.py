"""Transaction rules and window reports on the events table.

The functions are the ones used on streams; here they run on a table, so that
SQL can check them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from brightwell.functions.dates import seconds_between
from brightwell.functions.numbers import money, n_rows, round_half_up
from brightwell.operators import known, versions
from brightwell.operators.aggregate import attach_by_key
from brightwell.plans import derived
from brightwell.plans.registry import query, sql_count, sql_mean, sql_percent, sql_ratio, sql_round
from brightwell.streaming import combine, decode, latency, patterns, routing, rules, state, windows

AS_DOUBLE = ("transaction_fee", "tax_amount", "amount_usd", "net_amount")


@query("validate_events", f"""
WITH {derived.SQL_TXN}, {derived.SQL_CHECKED}
SELECT transaction_id, is_valid_amount, is_valid_currency, is_valid_account, is_valid_transaction_type,
  is_recent_transaction, is_valid_amount AND is_valid_currency AND is_valid_account AND is_valid_transaction_type
  AND is_recent_transaction AS overall_data_quality FROM checked""")
def validate_events(t):
    return rules.validate(derived.transactions(t.events), derived.latest_event(t)).select(
        "transaction_id", "is_valid_amount", "is_valid_currency", "is_valid_account",
        "is_valid_transaction_type", "is_recent_transaction", "overall_data_quality")


def _fees(preset):
    def build(t):
        priced = rules.add_amounts(derived.transactions(t.events), rules.PRESETS[preset])
        return priced.select("transaction_id", *[F.col(c).cast("double").alias(c) for c in AS_DOUBLE])
    return build


def _fees_sql(preset):
    return f"""WITH {derived.sql_enriched(preset)}
SELECT transaction_id, CAST(transaction_fee AS DOUBLE) AS transaction_fee, CAST(tax_amount AS DOUBLE) AS tax_amount,
  CAST(amount_usd AS DOUBLE) AS amount_usd,
  CAST(amount + transaction_fee + tax_amount AS DOUBLE) AS net_amount FROM enriched"""


query("fees_and_tax", _fees_sql("detailed"))(_fees("detailed"))
query("fees_and_tax_basic", _fees_sql("basic"))(_fees("basic"))
query("fees_and_tax_windowed", _fees_sql("windowed"))(_fees("windowed"))


@query("rate_table_join", f"""
WITH {derived.sql_enriched('detailed')}, rates AS (SELECT {derived.sql_pick(derived.CURRENCIES, 'n_nationkey')} AS currency,
  CAST(avg(1 + n_nationkey * 0.25) AS DOUBLE) AS rate FROM nation GROUP BY 1)
SELECT transaction_id, CAST(amount * COALESCE(rate, 1) AS DOUBLE) AS amount_usd
FROM enriched LEFT JOIN rates USING (currency)""")
def rate_table_join(t):
    key = F.col("n_nationkey")
    rates = t.nation.groupBy(derived.pick(derived.CURRENCIES, key).alias("currency")).agg(
        F.avg(1 + key * F.lit(0.25)).alias("rate"))
    return rules.with_rate_table(derived.transactions(t.events), rates).select(
        "transaction_id", F.col("amount_usd").cast("double").alias("amount_usd"))


@query("time_fields", f"""
WITH {derived.sql_enriched('detailed')}
SELECT transaction_id, CAST(transaction_hour AS INT) AS transaction_hour,
  CAST(transaction_day_of_week AS INT) AS transaction_day_of_week, CAST(month(event_timestamp) AS INT) AS transaction_month,
  is_weekend, NOT is_weekend AND transaction_hour BETWEEN 9 AND 17 AS is_business_hours, is_late_night,
  {derived.SQL_SECONDS.format(earlier='event_timestamp', later='kafka_timestamp')} AS processing_delay_seconds FROM enriched""")
def time_fields(t):
    return rules.add_time_fields(derived.transactions(t.events)).select(
        "transaction_id", "transaction_hour", "transaction_day_of_week", "transaction_month", "is_weekend",
        "is_business_hours", "is_late_night", "processing_delay_seconds")


def _risk(preset):
    return lambda t: derived.enriched(t, preset).select(
        "transaction_id", "is_high_value", "is_international", F.col("risk_score").cast("int").alias("risk_score"),
        "risk_level")


def _risk_sql(preset):
    return f"""WITH {derived.sql_enriched(preset)} SELECT transaction_id, is_high_value, is_international,
  CAST(risk_score AS INT) AS risk_score, risk_level FROM enriched"""


query("risk_score", _risk_sql("detailed"))(_risk("detailed"))
query("risk_score_basic", _risk_sql("basic"))(_risk("basic"))


@query("route_counts", f"""
WITH {derived.sql_enriched('detailed')} SELECT CASE WHEN overall_data_quality THEN 'valid' ELSE 'invalid' END AS route,
  risk_level, count(*) AS n_rows FROM enriched GROUP BY ALL""")
def route_counts(t):
    return routing.route_counts(derived.enriched(t, "detailed"))


@query("fraud_alerts", f"""
WITH {derived.sql_enriched('basic')} SELECT account_id AS key, transaction_id, CAST(amount_usd AS DOUBLE) AS amount_usd,
  risk_level, country FROM enriched WHERE risk_level = 'HIGH'""")
def fraud_alerts(t):
    alerts = routing.fraud_alerts(routing.route(derived.enriched(t, "basic")).high_risk)
    fields = F.from_json("value", "transaction_id STRING, amount_usd DOUBLE, risk_level STRING, country STRING")
    return alerts.select("key", fields.alias("v")).select("key", "v.*")


def _bucket(size, alias="window_start"):
    return f"time_bucket(INTERVAL {size}, event_timestamp) AS {alias}"


def _tumbling(size, keys, metrics, source="t", where="", ctes=derived.SQL_WINDOWED, ts="event_timestamp"):
    """SQL of a tumbling window report: one row per window and keys."""
    columns = ", ".join([f"time_bucket(INTERVAL {size}, {ts}) AS window_start", *keys, *metrics])
    return f"WITH {ctes} SELECT {columns} FROM {source} {where} GROUP BY ALL"


def _sliding(size_s, slide_s, keys, metrics, ctes=derived.SQL_WINDOWED):
    """SQL of a sliding window report: every row is repeated for each window that holds it."""
    first = f"time_bucket(INTERVAL {slide_s} SECONDS, event_timestamp)"
    starts = (f"generate_series({first} - INTERVAL {size_s - slide_s} SECONDS, {first}, INTERVAL {slide_s} SECONDS)")
    columns = ", ".join(["window_start", f"window_start + INTERVAL {size_s} SECONDS AS window_end", *keys, *metrics])
    return f"""WITH {ctes}, w AS (SELECT *, unnest({starts}) AS window_start FROM t)
SELECT {columns} FROM w GROUP BY ALL"""


USD_SUM = f"{sql_round('sum(amount_usd)')}"
USD_MEAN = f"{sql_round(sql_mean('amount_usd'))}"
STD = "stddev_samp(CAST(amount_usd AS DOUBLE))"


@query("tumbling_short", _tumbling("30 SECONDS", ["transaction_type", "channel"], [
    "count(*) AS transaction_count", f"{USD_SUM} AS total_volume_usd", f"{USD_MEAN} AS avg_amount_usd",
    f"{sql_round('max(amount_usd)')} AS max_amount_usd", f"{sql_count('is_high_value')} AS high_value_count",
    f"{sql_count('is_international')} AS international_count", "count(DISTINCT account_id) AS unique_customers",
    f"{sql_round('sum(transaction_fee)')} AS total_fees",
    f"{sql_percent(sql_count('is_high_value'), 'count(*)')} AS high_value_pct",
    f"{sql_percent(sql_count('is_international'), 'count(*)')} AS international_pct"]))
def tumbling_short(t):
    return windows.short_windows(derived.windowed_input(t)).drop("window_end")


@query("tumbling_mix", _tumbling("5 MINUTES", ["country"], [
    "count(*) AS transaction_count", f"{USD_SUM} AS total_volume_usd", f"{USD_MEAN} AS avg_transaction_size",
    f"{sql_round('min(amount_usd)')} AS min_amount", f"{sql_round('max(amount_usd)')} AS max_amount",
    f"{sql_round(STD)} AS amount_stddev",
    *[sql_percent(sql_count(f"transaction_type = '{k}'"), "count(*)") + f" AS {k}_pct" for k in windows.MIX_TYPES],
    *[sql_percent(sql_count(f"channel = '{c}'"), "count(*)") + f" AS {c}_pct" for c in windows.CHANNELS],
    "count(DISTINCT account_id) AS unique_customers", "count(DISTINCT merchant) AS unique_merchants",
    f"{sql_round('sum(transaction_fee)')} AS total_fees_generated",
    "strftime(time_bucket(INTERVAL 5 MINUTES, event_timestamp), '%H:%M:%S') || ' - ' || "
    "strftime(time_bucket(INTERVAL 5 MINUTES, event_timestamp) + INTERVAL 5 MINUTES, '%H:%M:%S') AS time_range"]))
def tumbling_mix(t):
    return windows.mix_windows(derived.windowed_input(t)).drop("window_end")


def _share(channel):
    return sql_percent(f"sum(CASE WHEN channel = '{channel}' THEN amount_usd ELSE 0 END)", "sum(amount_usd)")


@query("tumbling_hourly", _tumbling("1 HOUR", [], [
    "count(*) AS total_transactions", f"{USD_SUM} AS total_volume_usd", f"{USD_MEAN} AS avg_transaction_size",
    *[f"{sql_round(f'quantile_disc(amount_usd, {q})')} AS {name}"
      for name, q in (("median_amount", 0.5), ("p95_amount", 0.95), ("p99_amount", 0.99))],
    "count(DISTINCT account_id) AS unique_customers", "count(DISTINCT country) AS countries_served",
    "count(DISTINCT city) AS cities_served",
    *[f"{_share(c)} AS {c}_volume_pct" for c in ("online", "mobile", "atm")],
    f"{sql_percent(sql_count('is_high_value'), 'count(*)')} AS high_value_pct",
    f"{sql_percent(sql_count('is_international'), 'count(*)')} AS international_pct",
    f"{sql_round('sum(transaction_fee)')} AS total_fee_revenue",
    "min(event_timestamp) AS first_transaction_time", "max(event_timestamp) AS last_transaction_time",
    "strftime(time_bucket(INTERVAL 1 HOUR, event_timestamp), '%Y-%m-%d %H:00') AS hour_label",
    "CAST(hour(time_bucket(INTERVAL 1 HOUR, event_timestamp)) AS INT) AS hour_of_day",
    f"{sql_round(sql_ratio('count(*)', 'count(DISTINCT account_id)'))} AS transactions_per_customer"]))
def tumbling_hourly(t):
    return windows.hourly_windows(derived.windowed_input(t), known=derived.KNOWN).drop("window_end")


@query("business_day", f"""
WITH {derived.SQL_WINDOWED}, b AS (SELECT *, CAST(event_timestamp AS DATE) AS business_date, hour(event_timestamp) AS h
  FROM t WHERE hour(event_timestamp) >= 9 AND hour(event_timestamp) < 17),
hours AS (SELECT business_date AS d, country AS c, h, sum(amount_usd) AS usd FROM b GROUP BY 1, 2, 3),
peaks AS (SELECT d, c, arg_max(h, (usd, -h)) AS peak, max(usd) AS usd FROM hours GROUP BY 1, 2)
SELECT business_date, country, count(*) AS daily_transaction_count, {USD_SUM} AS daily_volume_usd,
  {USD_MEAN} AS daily_avg_amount, {sql_round('max(amount_usd)')} AS daily_max_transaction,
  CAST(any_value(peak) AS INT) AS peak_hour, {sql_round('any_value(usd)')} AS peak_hour_amount,
  count(DISTINCT account_id) AS daily_unique_customers, count(DISTINCT merchant) AS daily_unique_merchants,
  {sql_round('sum(transaction_fee)')} AS daily_fee_revenue, {sql_count('is_high_value')} AS daily_high_value_count,
  {sql_percent(sql_count('h BETWEEN 9 AND 11'), 'count(*)')} AS morning_pct,
  {sql_percent(sql_count('h BETWEEN 12 AND 14'), 'count(*)')} AS lunch_pct,
  {sql_percent(sql_count('h BETWEEN 15 AND 17'), 'count(*)')} AS afternoon_pct,
  min(event_timestamp) AS first_business_transaction, max(event_timestamp) AS last_business_transaction,
  {sql_percent(sql_count('is_high_value'), 'count(*)')} AS high_value_pct,
  {sql_round(sql_ratio('count(*)', 'count(DISTINCT account_id)'))} AS transactions_per_customer
FROM b JOIN peaks ON business_date = d AND country = c GROUP BY business_date, country""")
def business_day(t):
    return windows.business_days(derived.windowed_input(t))


def _first_totals(t):
    return derived.enriched(t, "basic").where("amount > 0")


_BASIC = derived.sql_enriched("basic") + ", t AS (SELECT * FROM enriched WHERE amount > 0)"


@query("tumbling_basic", _tumbling("1 MINUTES", [], [
    "count(*) AS total_transactions", f"{USD_SUM} AS total_volume_usd", f"{USD_MEAN} AS avg_amount_usd",
    f"{sql_round('min(amount_usd)')} AS min_amount_usd", f"{sql_round('max(amount_usd)')} AS max_amount_usd",
    "TRUE AS estimate_is_close"], ctes=_BASIC))
def tumbling_basic(t):
    """The account estimate lies within three standard errors of the exact count."""
    totals = _first_totals(t)
    exact = windows.windowed(totals, "1 minute", [], {"accounts": F.count_distinct("account_id")}).drop("window_end")
    report = attach_by_key(windows.basic_windows(totals), exact, ["window_start"])
    close = F.abs(F.col("unique_accounts") - F.col("accounts")) <= 3 * 0.05 * F.col("accounts") + 1
    return report.withColumn("estimate_is_close", close).drop("unique_accounts", "accounts", "window_end")


@query("tumbling_grouped", _tumbling("2 MINUTES", ["transaction_type", "country"], [
    "count(*) AS transaction_count", f"{USD_SUM} AS total_amount", f"{USD_MEAN} AS avg_amount",
    "count(DISTINCT account_id) AS unique_customers"], ctes=_BASIC))
def tumbling_grouped(t):
    return windows.grouped_windows(_first_totals(t))


@query("tumbling_channel", _tumbling("30 SECONDS", ["channel"], [
    "count(*) AS txn_count", f"{USD_SUM} AS volume", f"{sql_round(sql_mean('risk_score'), 1)} AS avg_risk",
    "strftime(time_bucket(INTERVAL 30 SECONDS, event_timestamp), '%H:%M:%S') AS start_time"], ctes=_BASIC))
def tumbling_channel(t):
    return windows.channel_windows(_first_totals(t))


@query("running_totals", f"""
WITH {_BASIC} SELECT transaction_type, count(*) AS total_count, {USD_SUM} AS total_volume, {USD_MEAN} AS avg_amount,
  count(DISTINCT account_id) AS unique_customers FROM t GROUP BY 1""")
def running_totals(t):
    return windows.running_totals(_first_totals(t))


@query("account_summary", f"""
WITH {derived.sql_enriched('basic')} SELECT {_bucket('1 MINUTE')},
  time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS window_end, account_id,
  count(*) AS transaction_count, CAST(sum(amount_usd) AS DOUBLE) AS total_amount_usd,
  {sql_round(sql_mean('risk_score'))} AS avg_risk_score, max(event_timestamp) AS last_transaction_time
FROM enriched WHERE overall_data_quality GROUP BY ALL""")
def account_summary(t):
    return routing.account_summary(routing.route(derived.enriched(t, "basic")).valid)


@query("type_risk_statistics", _tumbling("30 SECONDS", ["transaction_type", "risk_level"], [
    "count(*) AS count", f"{USD_MEAN} AS avg_amount_usd", f"{USD_SUM} AS total_amount_usd"],
    source="enriched", where="WHERE overall_data_quality", ctes=derived.sql_enriched("basic")))
def type_risk_statistics(t):
    return routing.type_risk_statistics(routing.route(derived.enriched(t, "basic")).valid)


@query("invalid_monitor", _tumbling("1 MINUTE", [], [
    "count(*) AS invalid_count", f"{sql_count('NOT is_valid_amount')} AS invalid_amounts",
    f"{sql_count('NOT is_valid_currency')} AS invalid_currencies",
    f"{sql_count('NOT is_valid_account')} AS invalid_accounts"],
    source="enriched", where="WHERE NOT overall_data_quality", ctes=derived.sql_enriched("basic")))
def invalid_monitor(t):
    return routing.invalid_monitor(routing.route(derived.enriched(t, "basic")).invalid)


@query("sliding_moving_avg", _sliding(300, 60, ["transaction_type"], [
    "count(*) AS transaction_count", f"{USD_MEAN} AS moving_avg_amount", f"{USD_SUM} AS total_volume",
    f"{sql_round('min(amount_usd)')} AS min_amount", f"{sql_round('max(amount_usd)')} AS max_amount",
    f"{sql_round(STD)} AS amount_stddev", "count(DISTINCT account_id) AS unique_customers",
    f"{sql_round(sql_mean('risk_score'), 1)} AS avg_risk_score", "min(event_timestamp) AS first_event",
    "max(event_timestamp) AS last_event", f"{sql_percent(STD, sql_mean('amount_usd'))} AS volatility_pct",
    "strftime(window_start, '%H:%M:%S') AS start_time",
    "strftime(window_start + INTERVAL 300 SECONDS, '%H:%M:%S') AS end_time"]))
def sliding_moving_avg(t):
    return windows.moving_averages(derived.windowed_input(t))


def _fraud_sql(size_s, slide_s):
    inner = _sliding(size_s, slide_s, ["account_id"], [
        "count(*) AS transaction_count", "sum(amount_usd) AS usd", "count(DISTINCT country) AS country_count",
        "count(DISTINCT city) AS city_count", "count(DISTINCT channel) AS channel_count",
        "count(DISTINCT merchant) AS merchant_count", f"{sql_count('is_high_value')} AS high_value_count",
        f"{sql_round(sql_mean('risk_score'), 1)} AS avg_risk_score", f"{sql_round('max(amount_usd)')} AS max_amount",
        "min(event_timestamp) AS first_ts", "max(event_timestamp) AS last_ts",
        "string_agg(DISTINCT country, ',' ORDER BY country) AS countries_list",
        "string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels_list"])
    span = f"CAST({derived.SQL_SECONDS.format(earlier='first_ts', later='last_ts')} AS DOUBLE) / 60"
    return f"""SELECT * EXCLUDE (usd, first_ts, last_ts),
  CASE WHEN fraud_score >= 80 THEN 'CRITICAL' WHEN fraud_score >= 60 THEN 'HIGH' WHEN fraud_score >= 40 THEN 'MEDIUM'
    WHEN fraud_score >= 20 THEN 'LOW' ELSE 'MINIMAL' END AS fraud_level, {sql_round('usd')} AS total_amount,
  {sql_round(sql_ratio('usd', 'transaction_count'))} AS avg_amount_per_txn, {sql_round(span, 1)} AS activity_span_minutes
FROM (SELECT *, CASE WHEN transaction_count >= 10 THEN 30 ELSE 0 END + CASE WHEN country_count >= 3 THEN 25 ELSE 0 END
  + CASE WHEN usd >= 10000 THEN 20 ELSE 0 END + CASE WHEN high_value_count >= 3 THEN 15 ELSE 0 END
  + CASE WHEN channel_count >= 3 THEN 10 ELSE 0 END AS fraud_score FROM ({inner})) WHERE fraud_score >= 20"""


@query("sliding_fraud", _fraud_sql(600, 30))
def sliding_fraud(t):
    return windows.fraud_windows(derived.windowed_input(t), known=derived.KNOWN)


@query("sliding_fraud_daily", _fraud_sql(172800, 21600))
def sliding_fraud_daily(t):
    return windows.fraud_windows(derived.windowed_input(t), "2 days", "6 hours", known=derived.KNOWN)


@query("sliding_velocity", f"""SELECT * EXCLUDE (usd, peak), strftime(window_start, '%H:%M') || '-' || strftime(window_end, '%H:%M') AS time_range,
  {sql_round('usd')} AS volume, {sql_round('txn_count / CAST(3 AS DOUBLE)', 1)} AS txn_per_minute,
  {sql_round('CAST(usd AS DOUBLE) / 3')} AS volume_per_minute,
  {sql_round('unique_accounts / CAST(3 AS DOUBLE)', 1)} AS customers_per_minute, {sql_round('peak')} AS peak_amount,
  {sql_round(sql_ratio('CAST(peak AS DOUBLE) * txn_count', 'usd'), 1)} AS peak_to_avg_ratio,
  CASE WHEN txn_count / 3.0 >= 50 THEN 'HIGH' WHEN txn_count / 3.0 >= 20 THEN 'MEDIUM' WHEN txn_count / 3.0 >= 5
    THEN 'NORMAL' ELSE 'LOW' END AS velocity_level
FROM ({_sliding(180, 30, ["country", "channel"], [
    "count(*) AS txn_count", "sum(amount_usd) AS usd", "count(DISTINCT account_id) AS unique_accounts",
    "max(amount_usd) AS peak", f"{sql_round('min(amount_usd)')} AS min_amount"])})""")
def sliding_velocity(t):
    return windows.velocity_windows(derived.windowed_input(t))


@query("sliding_trend", _sliding(900, 300, [], [
    "count(*) AS total_transactions", f"{USD_SUM} AS total_volume", f"{USD_MEAN} AS avg_amount",
    *[sql_percent(sql_count(f"transaction_type = '{k}'"), "count(*)") + f" AS {k}_pct" for k in windows.MIX_TYPES],
    *[f"{_share(c)} AS {c}_volume_pct" for c in ("online", "mobile", "atm")],
    f"{sql_round(sql_mean('risk_score'), 1)} AS avg_risk_score",
    f"{sql_percent(sql_count('is_high_value'), 'count(*)')} AS high_value_pct",
    "count(DISTINCT country) AS countries_active", "count(DISTINCT account_id) AS unique_customers",
    "strftime(window_start, '%H:%M') AS start_time",
    f"{sql_round(sql_ratio('count(*)', 'count(DISTINCT account_id)'), 1)} AS txn_per_customer"]))
def sliding_trend(t):
    return windows.trend_windows(derived.windowed_input(t), known=derived.KNOWN)


# Latency -----------------------------------------------------------------------

@query("delay_categories", f"""
WITH {derived.SQL_DELAYS} SELECT transaction_id, ingestion_delay_seconds, processing_delay_seconds, hop_delay_seconds,
  is_late_arriving, is_very_late, is_future_event, delay_category,
  time_bucket(INTERVAL 5 MINUTES, event_timestamp) AS time_bucket FROM t""")
def delay_categories(t):
    return latency.add_bucket(derived.with_delays(t)).select(
        "transaction_id", "ingestion_delay_seconds", "processing_delay_seconds", "hop_delay_seconds",
        "is_late_arriving", "is_very_late", "is_future_event", "delay_category", "time_bucket")


@query("ship_delay_categories", """
WITH d AS (SELECT date_diff('day', o_orderdate, l_shipdate) AS days FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT CASE WHEN days < 0 THEN 'FUTURE' WHEN days <= 5 THEN 'IMMEDIATE' WHEN days <= 30 THEN 'QUICK'
  WHEN days <= 300 THEN 'DELAYED' ELSE 'VERY_LATE' END AS delay_category, count(*) AS n_lines,
  min(days) AS min_days, max(days) AS max_days FROM d GROUP BY 1""")
def ship_delay_categories(t):
    lines = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.floor(seconds_between(F.col("o_orderdate"), F.col("l_shipdate")) / 86400)
    return lines.select(days.alias("days")).groupBy(
        latency.delay_category(F.col("days")).alias("delay_category")).agg(
        n_rows().alias("n_lines"), F.min("days").alias("min_days"), F.max("days").alias("max_days"))


@query("delay_distribution", _tumbling("1 MINUTE", ["delay_category"], [
    "count(*) AS transaction_count", f"{sql_round(sql_mean('ingestion_delay_seconds'))} AS avg_delay_seconds",
    "min(ingestion_delay_seconds) AS min_delay_seconds", "max(ingestion_delay_seconds) AS max_delay_seconds",
    f"{sql_round('stddev_samp(ingestion_delay_seconds)')} AS stddev_delay_seconds"],
    ctes=derived.SQL_DELAYS, ts="processing_timestamp"))
def delay_distribution(t):
    return latency.delay_distribution(derived.with_delays(t))


@query("time_basis_compare", f"""
WITH {derived.SQL_DELAYS}
SELECT time_bucket(INTERVAL 2 MINUTES, event_timestamp) AS window_start, transaction_type,
  count(*) AS transaction_count, {sql_round('sum(amount)')} AS volume,
  {sql_round(sql_mean('ingestion_delay_seconds'), 1)} AS avg_delay_seconds, 'EVENT_TIME' AS aggregation_type
FROM t GROUP BY ALL
UNION ALL SELECT time_bucket(INTERVAL 2 MINUTES, processing_timestamp), transaction_type, count(*),
  {sql_round('sum(amount)')}, CAST(0 AS DOUBLE), 'PROCESSING_TIME' FROM t GROUP BY ALL""")
def time_basis_compare(t):
    return latency.compare_clocks(derived.with_delays(t))


@query("late_impact", f"""
WITH {derived.SQL_DELAYS} SELECT {_bucket('1 MINUTE')},
  time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS window_end, country,
  count(*) AS late_transaction_count, {sql_round('sum(amount)')} AS late_transaction_volume,
  {sql_round(sql_mean('ingestion_delay_seconds'), 1)} AS avg_lateness_seconds,
  max(ingestion_delay_seconds) AS max_lateness_seconds, min(event_timestamp) AS earliest_event_in_window,
  max(processing_timestamp) AS latest_processing_time FROM t WHERE is_late_arriving GROUP BY ALL""")
def late_impact(t):
    return latency.late_impact(derived.with_delays(t))


def _inside(zone, first, last):
    local = f"timezone('{zone}', timezone('UTC', event_timestamp))"
    return f"hour({local}) BETWEEN {first} AND {last} AND dayofweek({local}) BETWEEN 1 AND 5"


@query("timezone_hours", _tumbling("5 MINUTES", [], [
    "count(*) AS total_transactions", f"{sql_round('sum(amount)')} AS total_volume",
    *[f"{sql_count(_inside(z, a, b))} AS {name}_business_hour_count" for name, z, a, b in latency.MARKETS],
    *[f"{sql_percent(sql_count(_inside(z, a, b)), 'count(*)')} AS {name}_business_pct"
      for name, z, a, b in latency.MARKETS]], ctes=derived.SQL_DELAYS))
def timezone_hours(t):
    return latency.market_hours(derived.with_delays(t))


@query("lateness_by_type", _tumbling("2 MINUTES", ["transaction_type"], [
    "count(*) AS transaction_count", f"{USD_SUM} AS total_volume",
    f"{sql_round(sql_mean('delay_seconds'), 1)} AS avg_delay_seconds", f"{sql_count('is_late_data')} AS late_data_count",
    f"{sql_count('is_very_late_data')} AS very_late_data_count", "max(delay_seconds) AS max_delay_seconds",
    "min(event_timestamp) AS earliest_event", "max(event_timestamp) AS latest_event",
    "'STRICT_10s' AS watermark_strategy"], source="late", ctes=derived.SQL_LATENESS))
def lateness_by_type(t):
    return latency.lateness_by_type(derived.with_lateness(t), "STRICT_10s").drop("window_end")


@query("lateness_no_watermark", _tumbling("2 MINUTES", ["transaction_type"], [
    "count(*) AS transaction_count", f"{sql_count('is_very_late_data')} AS very_late_data_count",
    "'NO_WATERMARK' AS watermark_strategy"], source="late", ctes=derived.SQL_LATENESS))
def lateness_no_watermark(t):
    return latency.lateness_by_type(derived.with_lateness(t), "NO_WATERMARK").select(
        "window_start", "transaction_type", "transaction_count", "very_late_data_count", "watermark_strategy")


@query("unique_events", """
SELECT user_id, event_type, ts, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def unique_events(t):
    return combine.unique_events(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], "ts")


@query("invoice_lines", """
SELECT CAST(o_orderkey AS VARCHAR) AS invoice, CAST(o_custkey AS VARCHAR) AS store, o_orderpriority AS city,
  CAST(l_partkey AS VARCHAR) AS item, l_quantity AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def invoice_lines(t):
    """Invoices are sent as JSON messages, one per order, and flattened again."""
    line = F.struct(F.col("l_partkey").cast("string").alias("ItemCode"), F.col("l_quantity").alias("ItemPrice"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(line).alias("InvoiceLineItems"))  # seven lines at most
    sent = t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("InvoiceNumber"), F.col("o_custkey").cast("string").alias("StoreID"),
        F.struct(F.col("o_orderpriority").alias("City")).alias("DeliveryAddress"), "InvoiceLineItems")).alias("value"))
    read = sent.select(F.from_json("value", decode.INVOICE_DDL).alias("v")).select("v.*")
    return decode.invoice_lines(read).select(
        F.col("InvoiceNumber").alias("invoice"), F.col("StoreID").alias("store"), F.col("City").alias("city"),
        F.col("ItemCode").alias("item"), F.col("ItemPrice").alias("quantity"))


@query("lateness_by_place", _tumbling("2 MINUTES", ["country", "channel"], [
    "count(*) AS transaction_count", f"{USD_SUM} AS total_volume", f"{USD_MEAN} AS avg_amount",
    "count(DISTINCT account_id) AS unique_customers", f"{sql_count('is_late_data')} AS late_data_count",
    f"{sql_count('is_very_late_data')} AS very_late_data_count",
    f"{sql_round(sql_mean('delay_seconds'), 1)} AS avg_delay_seconds",
    f"{sql_percent(sql_count('is_late_data'), 'count(*)')} AS late_data_pct",
    "min(event_timestamp) AS window_first_event", "max(event_timestamp) AS window_last_event"],
    source="late", ctes=derived.SQL_LATENESS))
def lateness_by_place(t):
    return latency.lateness_by_place(derived.with_lateness(t)).drop("window_end", "time_range", "watermark_strategy")


@query("lateness_overview", _tumbling("10 MINUTES", [], [
    "count(*) AS total_transactions", f"{USD_SUM} AS total_volume", "count(DISTINCT account_id) AS unique_customers",
    "count(DISTINCT country) AS countries_served",
    *[sql_percent(sql_count(f"delay_category = '{c}'"), "count(*)") + f" AS {c.lower()}_pct"
      for c in ("IMMEDIATE", "QUICK", "NORMAL", "LATE", "VERY_LATE")],
    f"{sql_round(sql_mean('delay_seconds'), 1)} AS avg_delay_sec",
    *[f"quantile_disc(delay_seconds, {q}) AS {n}" for n, q in
      (("median_delay_sec", 0.5), ("p95_delay_sec", 0.95), ("p99_delay_sec", 0.99))],
    "strftime(time_bucket(INTERVAL 10 MINUTES, event_timestamp), '%H:%M') AS start_time",
    "'RELAXED_1hr' AS watermark_strategy"], source="late", ctes=derived.SQL_LATENESS))
def lateness_overview(t):
    return latency.lateness_overview(derived.with_lateness(t), known=derived.KNOWN).drop("window_end")


@query("lateness_monitor", _tumbling("1 MINUTE", ["delay_category"], [
    "count(*) AS event_count", f"{sql_round(sql_mean('delay_seconds'), 1)} AS avg_delay_seconds",
    "min(delay_seconds) AS min_delay", "max(delay_seconds) AS max_delay", f"{USD_SUM} AS total_volume",
    f"{sql_count('amount_usd >= 1000')} AS high_value_late_count",
    f"{sql_round('sum(CASE WHEN amount_usd >= 1000 THEN amount_usd ELSE 0 END)')} AS high_value_late_volume",
    f"{sql_percent('sum(CASE WHEN amount_usd >= 1000 THEN amount_usd ELSE 0 END)', 'sum(amount_usd)')} AS high_value_impact_pct"],
    source="late", ctes=derived.SQL_LATENESS, ts="processing_timestamp"))
def lateness_monitor(t):
    return latency.lateness_monitor(derived.with_lateness(t))


# Combining ---------------------------------------------------------------------

@query("interval_join", """
SELECT a.user_id, a.event_id AS click_id, b.event_id AS purchase_id, a.ts AS click_ts, b.ts AS purchase_ts
FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 6 HOURS
WHERE a.event_type = 'click' AND b.event_type = 'purchase'""")
def interval_join(t):
    events = t.events.select("user_id", "event_id", "ts", "event_type")
    return combine.join_within(events.where("event_type = 'click'"), events.where("event_type = 'purchase'"),
                               "user_id", "ts", "ts", "6 HOURS").select(
        F.col("a.user_id").alias("user_id"), F.col("a.event_id").alias("click_id"),
        F.col("b.right_event_id").alias("purchase_id"), F.col("a.ts").alias("click_ts"),
        F.col("b.right_ts").alias("purchase_ts"))


def _outer_join(how):
    def build(t):
        events = t.events.select("user_id", "event_id", "ts", "event_type")
        joined = combine.join_within(events.where("event_type = 'click'"), events.where("event_type = 'purchase'"),
                                     "user_id", "ts", "ts", "2 HOURS", how=how)
        return joined.select(F.coalesce("user_id", "right_user_id").alias("user_id"), F.col("event_id").alias("click_id"),
                             F.col("right_event_id").alias("purchase_id"))
    return build


for _how in ("left", "right", "full"):
    query(f"interval_join_{_how}", f"""
SELECT coalesce(a.user_id, b.user_id) AS user_id, a.event_id AS click_id, b.event_id AS purchase_id
FROM (SELECT * FROM events WHERE event_type = 'click') a {_how.upper()} JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 2 HOURS""")(_outer_join(f"{_how}_outer"))


FUNNEL = (patterns.Step("view", "event_type = 'view'"), patterns.Step("click", "event_type = 'click' AND value > 10"),
          patterns.Step("purchase", "event_type = 'purchase'"))


@query("three_step_pattern", """
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events),
n AS (SELECT *, min(CASE WHEN event_type = 'click' AND value > 10 THEN place END) OVER w AS next_click,
  min(CASE WHEN event_type = 'purchase' THEN place END) OVER w AS next_purchase FROM e
  WINDOW w AS (PARTITION BY user_id ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT a.user_id, a.ts AS view_ts, a.event_id AS view_event_id, b.ts AS click_ts, b.event_id AS click_event_id,
  c.ts AS purchase_ts, c.event_id AS purchase_event_id
FROM n a JOIN n b ON b.user_id = a.user_id AND b.place = a.next_click JOIN n c ON c.user_id = a.user_id AND c.place = b.next_purchase
WHERE a.event_type = 'view' AND c.ts <= a.ts + INTERVAL 3 DAYS""")
def three_step_pattern(t):
    """A view, then a click of some value, then a purchase, within three days."""
    return patterns.find(t.events, "user_id", "ts", "event_id", FUNNEL, "3 days")


@query("merged_streams", f"""
SELECT origin, count(*) AS n_rows, {sql_round('sum(CAST(value AS DECIMAL(18,2)))')} AS total_value FROM (
  SELECT 0 AS origin, value FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT 1, value FROM events WHERE event_type = 'signup') GROUP BY origin""")
def merged_streams(t):
    parts = [t.events.where(F.col("event_type") == kind).select("value") for kind in ("purchase", "signup")]
    return combine.merge(*parts, tag="origin").groupBy("origin").agg(
        n_rows().alias("n_rows"), round_half_up(F.sum(money("value"))).alias("total_value"))


@query("as_of_versions", """
SELECT o_orderkey, o_custkey, o_orderdate, (SELECT max_by(u.o_orderkey, (u.o_orderdate, u.o_orderkey)) FROM orders u
  WHERE u.o_custkey = o.o_custkey AND u.o_orderdate <= o.o_orderdate AND u.o_orderpriority = '1-URGENT') AS urgent_orderkey FROM orders o""")
def as_of_versions(t):
    """Each order with its customer's latest urgent order at its own date."""
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderdate", "o_orderkey")
    found = versions.as_of(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), urgent, "o_custkey", "o_orderdate", "o_orderdate")
    return found.select("o_orderkey", "o_custkey", "o_orderdate", F.col("version_o_orderkey").alias("urgent_orderkey"))


@query("probably_new_events", """
SELECT count(DISTINCT (user_id, event_type)) AS n_keys, TRUE AS none_twice, TRUE AS nearly_all FROM events""")
def probably_new_events(t):
    """Approximate de-duplication lets no key through twice and holds few back."""
    events = t.events.select("user_id", "event_type", "ts", "event_id")
    kept = state.probably_new(events, ["user_id", "event_type"], "ts", keep="3650 days")
    exact = events.groupBy("user_id", "event_type").agg(n_rows().alias("n")).agg(n_rows()).scalar()
    return kept.groupBy("user_id", "event_type").agg(n_rows().alias("n")).agg(
        F.max("n").alias("most"), n_rows().alias("kept")).select(
        exact.alias("n_keys"), (F.col("most") == 1).alias("none_twice"), (F.col("kept") >= 0.99 * exact).alias("nearly_all"))


@query("known_orders_filtered", """
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (WHERE o_orderdate >= DATE '1998-01-01') AS n_new,
  TRUE AS none_missed, TRUE AS nearly_all FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_returnflag""")
def known_orders_filtered(t):
    """Lines of orders that a filter of earlier orders, grown by a year, does not know."""
    early, year = t.orders.where("o_orderdate < DATE'1997-01-01'"), t.orders.where("year(o_orderdate) = 1997")
    key = ["o_orderkey"]
    filters = known.extend(known.key_filter(early, key), year, key)
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    new = F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")
    passed = known.unknown(lines.select("o_orderkey", "o_orderdate", "l_returnflag"), key, filters)
    counts = [lines.groupBy("l_returnflag").agg(n_rows().alias("n_rows"), F.count_if(new).alias("n_new")),
              passed.groupBy("l_returnflag").agg(n_rows().alias("n_passed"), F.count_if(~new).alias("n_missed"))]
    return counts[0].join(counts[1], "l_returnflag", "left").na.fill(0, ["n_passed", "n_missed"]).select(
        "l_returnflag", "n_rows", "n_new", (F.col("n_missed") == 0).alias("none_missed"),
        # A share of keys below 0.01 is held back; rows come in orders of a few lines.
        (F.col("n_passed") >= 0.98 * F.col("n_new")).alias("nearly_all"))
