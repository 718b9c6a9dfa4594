"""Tumbling and sliding window reports on enriched transactions.

Input columns: event_timestamp, transaction_type, channel, country, city,
merchant, account_id, amount_usd, transaction_fee, is_high_value,
is_international, risk_score. All functions return unsorted rows and run on a
table or a stream. Sliding reports on a table come from panes (``panes.sliding``),
so no row is repeated for each window. Columns whose values are listed (``known``) are counted by
bit masks. Other distinct counts are exact on a table and estimates with bounded
state on a stream, but for countries, cities and channels in the fraud report,
whose score needs exact counts: without a list it keeps their sets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.functions.bands import at_least, points
from brightwell.functions.dates import seconds_between
from brightwell.functions.numbers import (
    count_when,
    mean,
    n_rows as rows,
    percent,
    ratio,
    round_half_up,
    sample_deviation,
    sum_when,
)
from brightwell.operators.aggregate import (
    approx_percentiles,
    attach_by_key,
    distinct_count,
    few_distinct,
    masked_count,
    masked_values,
    percentiles,
    sketched_count,
    value_masks,
)
from brightwell.streaming.panes import State, sliding

TS = "event_timestamp"
NOTHING: Mapping[str, Sequence] = {}
USD = "amount_usd"
# The types and channels reported on their own.
MIX_TYPES = ("purchase", "withdrawal", "transfer", "deposit")
CHANNELS = ("online", "atm", "pos", "mobile")
FRAUD_LEVELS = ((80, "CRITICAL"), (60, "HIGH"), (40, "MEDIUM"), (20, "LOW"))
VELOCITY_LEVELS = ((50, "HIGH"), (20, "MEDIUM"), (5, "NORMAL"))


def windowed(df: DataFrame, size: str, keys: Sequence[str], metrics: Mapping[str, Column],
             slide: str | None = None, ts: str = TS) -> DataFrame:
    """Group by time window (sliding when ``slide`` is given) and keys."""
    grouped = df.groupBy(F.window(ts, size, slide) if slide else F.window(ts, size), *keys)
    names = list(metrics)
    return grouped.agg(*[metrics[name].alias(name) for name in names]).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *names)


def with_percentiles(df: DataFrame, size: str, value: str, points: Mapping[str, float],
                     metrics: Mapping[str, Column]) -> DataFrame:
    """A tumbling report with percentiles: exact on a table, where they are found
    apart from the other metrics and joined by window; estimates on a stream."""
    if df.isStreaming:
        return windowed(df, size, [], {**metrics, **approx_percentiles(value, points)})
    start = F.window(TS, size)["start"]
    exact = percentiles(df.select(start.alias("window_start"), value), ["window_start"], value, points)
    return attach_by_key(windowed(df, size, [], metrics), exact, ["window_start"])


def _usd_sum(condition: Column | None = None) -> Column:
    return F.sum(USD) if condition is None else sum_when(condition, F.col(USD))


def _time_range(pattern: str, joiner: str) -> Column:
    return F.concat(F.date_format("window_start", pattern), F.lit(joiner),
                    F.date_format("window_end", pattern))


def short_windows(df: DataFrame, size: str = "30 seconds") -> DataFrame:
    """Live view by type and channel."""
    return windowed(df, size, ["transaction_type", "channel"], {
        "transaction_count": rows(),
        "total_volume_usd": round_half_up(_usd_sum()),
        "avg_amount_usd": round_half_up(mean(USD)),
        "max_amount_usd": round_half_up(F.max(USD)),
        "high_value_count": count_when("is_high_value"),
        "international_count": count_when("is_international"),
        "unique_customers": distinct_count(df, "account_id"),
        "total_fees": round_half_up(F.sum("transaction_fee")),
    }).withColumns({
        "high_value_pct": percent("high_value_count", "transaction_count"),
        "international_pct": percent("international_count", "transaction_count")})


def mix_windows(df: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Operations view by country: type and channel mix."""
    counts = {f"{kind}_pct": percent(count_when(F.col("transaction_type") == kind), rows())
              for kind in MIX_TYPES}
    counts |= {f"{channel}_pct": percent(count_when(F.col("channel") == channel), rows())
               for channel in CHANNELS}
    return windowed(df, size, ["country"], {
        "transaction_count": rows(),
        "total_volume_usd": round_half_up(_usd_sum()),
        "avg_transaction_size": round_half_up(mean(USD)),
        "min_amount": round_half_up(F.min(USD)), "max_amount": round_half_up(F.max(USD)),
        "amount_stddev": round_half_up(F.stddev_samp(F.col(USD).cast("double"))),
        **counts,
        "unique_customers": distinct_count(df, "account_id"),
        "unique_merchants": distinct_count(df, "merchant"),
        "total_fees_generated": round_half_up(F.sum("transaction_fee")),
    }).withColumn("time_range", _time_range("HH:mm:ss", " - "))


def hourly_windows(df: DataFrame, size: str = "1 hour", known: Mapping[str, Sequence] = NOTHING) -> DataFrame:
    """Business view: percentiles, customers, channel share of the volume. ``known``
    lists all values of columns with few, which are then counted by bit masks."""
    shares = {f"{channel}_volume_pct": percent(_usd_sum(F.col("channel") == channel), _usd_sum())
              for channel in ("online", "mobile", "atm")}
    points = {"median_amount": 0.5, "p95_amount": 0.95, "p99_amount": 0.99}
    report = with_percentiles(df, size, USD, points, {
        "total_transactions": rows(),
        "total_volume_usd": round_half_up(_usd_sum()),
        "avg_transaction_size": round_half_up(mean(USD)),
        "unique_customers": distinct_count(df, "account_id"),
        "countries_served": few_distinct(df, "country", known.get("country")),
        "cities_served": few_distinct(df, "city", known.get("city")),
        **shares,
        "high_value_pct": percent(count_when("is_high_value"), rows()),
        "international_pct": percent(count_when("is_international"), rows()),
        "total_fee_revenue": round_half_up(F.sum("transaction_fee")),
        "first_transaction_time": F.min(TS), "last_transaction_time": F.max(TS),
    })
    return report.withColumns({
        **{name: round_half_up(name) for name in points},
        "hour_label": F.date_format("window_start", "yyyy-MM-dd HH:00"),
        "hour_of_day": F.hour("window_start"),
        "transactions_per_customer": round_half_up(ratio("total_transactions", "unique_customers"))})


def business_days(df: DataFrame, opens: int = 9, closes: int = 17) -> DataFrame:
    """Day view of business hours (``closes`` excluded) by country, with the hour of
    the largest volume (the earliest of equal ones) and the parts of the day."""
    hour = F.col("transaction_hour")
    open_rows = (df.withColumn("transaction_hour", F.hour(TS)).where((hour >= opens) & (hour < closes))
                 .withColumn("business_date", F.to_date(TS)))
    parts = {"morning_pct": (9, 11), "lunch_pct": (12, 14), "afternoon_pct": (15, 17)}
    # One sum for each open hour: a fixed few, so a single aggregate does on streams too.
    volumes = F.array(*[F.struct(F.sum(F.when(hour == h, F.col(USD))).alias("usd"), F.lit(-h).alias("back"))
                        for h in range(opens, closes)])
    peak = F.array_max(volumes)
    return open_rows.groupBy("business_date", "country").agg(
        rows().alias("daily_transaction_count"),
        round_half_up(_usd_sum()).alias("daily_volume_usd"),
        round_half_up(mean(USD)).alias("daily_avg_amount"),
        round_half_up(F.max(USD)).alias("daily_max_transaction"),
        (-peak["back"]).alias("peak_hour"),
        round_half_up(peak["usd"]).alias("peak_hour_amount"),
        distinct_count(df, "account_id").alias("daily_unique_customers"),
        distinct_count(df, "merchant").alias("daily_unique_merchants"),
        round_half_up(F.sum("transaction_fee")).alias("daily_fee_revenue"),
        count_when("is_high_value").alias("daily_high_value_count"),
        *[percent(count_when(hour.between(low, high)), rows()).alias(name)
          for name, (low, high) in parts.items()],
        F.min(TS).alias("first_business_transaction"), F.max(TS).alias("last_business_transaction"),
    ).withColumns({
        "high_value_pct": percent("daily_high_value_count", "daily_transaction_count"),
        "transactions_per_customer": round_half_up(
            ratio("daily_transaction_count", "daily_unique_customers"))})


def basic_windows(df: DataFrame, size: str = "1 minute", rsd: float = 0.05) -> DataFrame:
    """First totals; the account count is an estimate on tables and streams alike."""
    return windowed(df, size, [], {
        "total_transactions": rows(),
        "total_volume_usd": round_half_up(_usd_sum()), "avg_amount_usd": round_half_up(mean(USD)),
        "min_amount_usd": round_half_up(F.min(USD)), "max_amount_usd": round_half_up(F.max(USD)),
        "unique_accounts": sketched_count("account_id", rsd)})


def grouped_windows(df: DataFrame, size: str = "2 minutes") -> DataFrame:
    """By type and country."""
    return windowed(df, size, ["transaction_type", "country"], {
        "transaction_count": rows(), "total_amount": round_half_up(_usd_sum()),
        "avg_amount": round_half_up(mean(USD)),
        "unique_customers": distinct_count(df, "account_id")}).drop("window_end")


def channel_windows(df: DataFrame, size: str = "30 seconds") -> DataFrame:
    """Count, volume and mean risk by channel."""
    return windowed(df, size, ["channel"], {
        "txn_count": rows(), "volume": round_half_up(_usd_sum()),
        "avg_risk": round_half_up(mean("risk_score"), 1),
    }).withColumn("start_time", F.date_format("window_start", "HH:mm:ss")).drop("window_end")


def running_totals(df: DataFrame) -> DataFrame:
    """Totals since the start by type (complete or update mode on a stream)."""
    return df.groupBy("transaction_type").agg(
        rows().alias("total_count"), round_half_up(_usd_sum()).alias("total_volume"),
        round_half_up(mean(USD)).alias("avg_amount"),
        distinct_count(df, "account_id").alias("unique_customers"))


def slid(df: DataFrame, size: str, slide: str, keys: Sequence[str], states: Mapping[str, State],
         distinct: Mapping[str, str], where: Column | None = None) -> DataFrame:
    """Sliding windows: from panes on a table; on a stream, which keeps one state for
    each window and key anyway, by Spark's own windows."""
    if not df.isStreaming:
        return sliding(df, size, slide, keys, states, distinct, where)
    metrics = {name: state.aggregate for name, state in states.items()}
    metrics |= {name: distinct_count(df, column) for name, column in distinct.items()}
    found = windowed(df, size, keys, metrics, slide)
    return found if where is None else found.where(where)


def usd_states() -> dict[str, State]:
    """What most sliding reports merge: rows, amounts and risk."""
    return {"__n": State(rows()), "__usd": State(F.sum(USD)), "__usd_n": State(F.count(USD)),
            "__low": State(F.min(USD), "min"), "__high": State(F.max(USD), "max"),
            "__risk": State(F.sum("risk_score")), "__risk_n": State(F.count("risk_score"))}


def mean_usd() -> Column:
    return ratio("__usd", "__usd_n")


def mean_risk() -> Column:
    return round_half_up(ratio("__risk", "__risk_n"), 1)


def moving_averages(df: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Moving mean and volatility by type."""
    square = F.col(USD).cast("decimal(18,4)") * F.col(USD).cast("decimal(18,4)")
    spread = sample_deviation("__usd_n", "__usd", "__squares")
    states = {**usd_states(), "__squares": State(F.sum(square)), "first_event": State(F.min(TS), "min"), "last_event": State(F.max(TS), "max")}
    return slid(df, size, slide, ["transaction_type"], states, {"unique_customers": "account_id"}).select(
        "window_start", "window_end", "transaction_type",
        F.col("__n").alias("transaction_count"), round_half_up(mean_usd()).alias("moving_avg_amount"),
        round_half_up("__usd").alias("total_volume"), round_half_up("__low").alias("min_amount"),
        round_half_up("__high").alias("max_amount"), round_half_up(spread).alias("amount_stddev"),
        "unique_customers", mean_risk().alias("avg_risk_score"), "first_event", "last_event",
        percent(spread, mean_usd()).alias("volatility_pct"),
        F.date_format("window_start", "HH:mm:ss").alias("start_time"), F.date_format("window_end", "HH:mm:ss").alias("end_time"))


def fraud_windows(df: DataFrame, size: str = "10 minutes", slide: str = "30 seconds",
                  min_score: int = 20, known: Mapping[str, Sequence] = NOTHING) -> DataFrame:
    """Accounts with unusual activity: score, level and time span.

    ``known`` lists all values of country, city, channel or merchant; a column
    that is not listed costs a set of its values per window and account.
    """
    seen = {"country": "countries_list", "city": None, "channel": "channels_list"}
    states, counts, lists, distinct = {}, {}, {}, {}
    for column in (*seen, "merchant"):
        values = sorted(known.get(column, ()))
        if values:
            masks = {f"__{column}{i}": State(mask, "or") for i, mask in enumerate(value_masks(column, values))}
            states |= masks
            counts[f"{column}_count"] = masked_count([F.col(name) for name in masks])
            found = masked_values([F.col(name) for name in masks], values)
        elif column == "merchant":
            distinct["merchant_count"] = column
        else:
            states[f"__{column}"] = State(F.array_sort(F.collect_set(column)), "set")
            counts[f"{column}_count"] = F.size(f"__{column}").cast("long")
            found = F.col(f"__{column}")
        if seen.get(column):
            lists[seen[column]] = F.array_join(found, ",")
    states |= {**usd_states(), "high_value_count": State(count_when("is_high_value")),
               "__first": State(F.min(TS), "min"), "__last": State(F.max(TS), "max")}
    # Points per sign of fraud.
    score = points([
        (F.col("__n") >= 10, 30), (counts["country_count"] >= 3, 25), (F.col("__usd") >= 10_000, 20),
        (F.col("high_value_count") >= 3, 15), (counts["channel_count"] >= 3, 10)])
    activity = slid(df, size, slide, ["account_id"], states, distinct, score >= min_score)
    return (activity.withColumns({**counts, "fraud_score": score, "transaction_count": F.col("__n")})
            .withColumns({
                **lists, "avg_risk_score": mean_risk(), "max_amount": round_half_up("__high"),
                "fraud_level": at_least(F.col("fraud_score"), FRAUD_LEVELS, "MINIMAL"),
                "total_amount": round_half_up("__usd"), "avg_amount_per_txn": round_half_up(ratio("__usd", "__n")),
                "activity_span_minutes": round_half_up(
                    seconds_between(F.col("__first"), F.col("__last")) / F.lit(60.0), 1)})
            .select("window_start", "window_end", "account_id", "transaction_count", *[f"{c}_count" for c in seen], "merchant_count",
                    "high_value_count", "avg_risk_score", "max_amount", "fraud_score", *lists, "fraud_level", "total_amount",
                    "avg_amount_per_txn", "activity_span_minutes"))


def velocity_windows(df: DataFrame, size: str = "3 minutes", slide: str = "30 seconds") -> DataFrame:
    """Rates per minute by country and channel."""
    per_minute = (F.unix_timestamp("window_end") - F.unix_timestamp("window_start")) / F.lit(60.0)
    found = slid(df, size, slide, ["country", "channel"], usd_states(), {"unique_accounts": "account_id"})
    return found.select(
        "window_start", "window_end", "country", "channel", F.col("__n").alias("txn_count"), "unique_accounts",
        round_half_up("__low").alias("min_amount"), _time_range("HH:mm", "-").alias("time_range"),
        round_half_up("__usd").alias("volume"),
        round_half_up(F.col("__n") / per_minute, 1).alias("txn_per_minute"),
        round_half_up(F.col("__usd").cast("double") / per_minute).alias("volume_per_minute"),
        round_half_up(F.col("unique_accounts") / per_minute, 1).alias("customers_per_minute"),
        round_half_up("__high").alias("peak_amount"),
        round_half_up(ratio(F.col("__high").cast("double") * F.col("__n"), "__usd"), 1).alias("peak_to_avg_ratio"),
        at_least(F.col("__n") / per_minute, VELOCITY_LEVELS, "LOW").alias("velocity_level"))


def trend_windows(df: DataFrame, size: str = "15 minutes", slide: str = "5 minutes",
                  known: Mapping[str, Sequence] = NOTHING) -> DataFrame:
    """Mix, channel share, risk and customers over a sliding window."""
    parts = {f"__{kind}": State(count_when(F.col("transaction_type") == kind)) for kind in MIX_TYPES}
    shares = ("online", "mobile", "atm")
    parts |= {f"__{channel}": State(_usd_sum(F.col("channel") == channel)) for channel in shares}
    masks = {f"__country{i}": State(m, "or") for i, m in enumerate(value_masks("country", known["country"]))} if known.get("country") else {}
    distinct = {"unique_customers": "account_id"} | ({} if masks else {"countries_active": "country"})
    found = slid(df, size, slide, [], {**usd_states(), **parts, **masks, "__high_value": State(count_when("is_high_value"))}, distinct)
    if masks:
        found = found.withColumn("countries_active", masked_count([F.col(name) for name in masks]))
    return found.select(
        "window_start", "window_end", F.col("__n").alias("total_transactions"), round_half_up("__usd").alias("total_volume"),
        round_half_up(mean_usd()).alias("avg_amount"), *[percent(f"__{kind}", "__n").alias(f"{kind}_pct") for kind in MIX_TYPES],
        *[percent(f"__{channel}", "__usd").alias(f"{channel}_volume_pct") for channel in shares], mean_risk().alias("avg_risk_score"),
        percent("__high_value", "__n").alias("high_value_pct"), "countries_active", "unique_customers",
        F.date_format("window_start", "HH:mm").alias("start_time"),
        round_half_up(ratio("__n", "unique_customers"), 1).alias("txn_per_customer"))
