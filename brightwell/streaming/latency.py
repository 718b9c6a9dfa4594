"""Event time against arrival time: delays, late rows, zones, watermarks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.functions.bands import below
from brightwell.functions.dates import seconds_between, time_bucket, zone_business_hours
from brightwell.functions.numbers import (
    count_when,
    mean,
    percent,
    round_half_up,
    sum_when,
)
from brightwell.operators.aggregate import distinct_count, few_distinct
from brightwell.streaming.windows import NOTHING, TS, USD, rows, windowed, with_percentiles

# Limits in seconds, inclusive.
DELAY_STEPS = ((5, "IMMEDIATE"), (30, "QUICK"), (300, "DELAYED"))
LATE_STEPS = ((5, "IMMEDIATE"), (30, "QUICK"), (60, "NORMAL"), (300, "LATE"))
# Market, zone, first and last business hour (both inclusive).
MARKETS = (("ny", "America/New_York", 9, 16), ("london", "Europe/London", 8, 16),
           ("tokyo", "Asia/Tokyo", 9, 15))
# Named watermark delays.
WATERMARKS = {"STRICT_10s": "10 seconds", "BALANCED_5min": "5 minutes", "RELAXED_1hr": "1 hour"}


def delay_category(seconds: Column) -> Column:
    return F.when(seconds < 0, "FUTURE").otherwise(below(seconds, DELAY_STEPS, "VERY_LATE", inclusive=True))


def add_delays(df: DataFrame, event: str = TS, ingested: str = "kafka_timestamp",
               processed: str = "processing_timestamp", late_after: int = 30,
               very_late_after: int = 300) -> DataFrame:
    """Delays between the three clocks, late flags and the delay category."""
    e, i, p = F.col(event), F.col(ingested), F.col(processed)
    delay = F.col("ingestion_delay_seconds")
    return df.withColumns({
        "ingestion_delay_seconds": seconds_between(e, i),
        "processing_delay_seconds": seconds_between(e, p),
        "hop_delay_seconds": seconds_between(i, p),
    }).withColumns({
        "is_late_arriving": delay > late_after, "is_very_late": delay > very_late_after,
        "is_future_event": e > p,
        "event_hour_utc": F.hour(e), "event_day_of_week": F.dayofweek(e),
        "processing_hour_utc": F.hour(p),
        "delay_category": delay_category(delay)})


def add_bucket(df: DataFrame, size: str = "5 minutes", name: str = "time_bucket") -> DataFrame:
    """Start of the bucket of the event time."""
    return df.withColumn(name, time_bucket(F.col(TS), size))


def delay_distribution(df: DataFrame, size: str = "1 minute",
                       processed: str = "processing_timestamp") -> DataFrame:
    """Delays by category per minute of processing time."""
    delay = "ingestion_delay_seconds"
    return windowed(df, size, ["delay_category"], {
        "transaction_count": rows(), "avg_delay_seconds": round_half_up(mean(delay)),
        "min_delay_seconds": F.min(delay), "max_delay_seconds": F.max(delay),
        "stddev_delay_seconds": round_half_up(F.stddev_samp(F.col(delay).cast("double"))),
    }, ts=processed).drop("window_end")


def compare_clocks(df: DataFrame, size: str = "2 minutes", processed: str = "processing_timestamp",
                   amount: str = "amount", keys: tuple[str, ...] = ("transaction_type",)) -> DataFrame:
    """The same counts by event time and by processing time, one above the other."""
    def by(ts, label, delay):
        return windowed(df, size, list(keys), {
            "transaction_count": rows(),
            "volume": round_half_up(F.sum(F.col(amount).cast("decimal(18,2)"))),
            "avg_delay_seconds": delay}, ts=ts).drop("window_end").withColumn(
                "aggregation_type", F.lit(label))
    return by(TS, "EVENT_TIME", round_half_up(mean("ingestion_delay_seconds"), 1)).unionByName(
        by(processed, "PROCESSING_TIME", F.max(F.lit(0.0))))


def late_impact(df: DataFrame, size: str = "1 minute", processed: str = "processing_timestamp",
                amount: str = "amount") -> DataFrame:
    """What late rows add to event-time windows, by country."""
    delay = "ingestion_delay_seconds"
    return windowed(df.where("is_late_arriving"), size, ["country"], {
        "late_transaction_count": rows(),
        "late_transaction_volume": round_half_up(F.sum(F.col(amount).cast("decimal(18,2)"))),
        "avg_lateness_seconds": round_half_up(mean(delay), 1),
        "max_lateness_seconds": F.max(delay),
        "earliest_event_in_window": F.min(TS), "latest_processing_time": F.max(processed)})


def market_hours(df: DataFrame, size: str = "5 minutes", amount: str = "amount",
                 markets=MARKETS) -> DataFrame:
    """Share of the rows inside the business hours of each market."""
    inside = {name: zone_business_hours(F.col(TS), zone, first, last)
              for name, zone, first, last in markets}
    metrics = {"total_transactions": rows(),
               "total_volume": round_half_up(F.sum(F.col(amount).cast("decimal(18,2)")))}
    metrics |= {f"{name}_business_hour_count": count_when(hours) for name, hours in inside.items()}
    result = windowed(df, size, [], metrics).drop("window_end")
    return result.withColumns({
        f"{name}_business_pct": percent(f"{name}_business_hour_count", "total_transactions")
        for name in inside})


def add_lateness(df: DataFrame, event: str = TS, processed: str = "processing_timestamp") -> DataFrame:
    """Delay in seconds with the late flags and category of the watermark reports."""
    delay = F.col("delay_seconds")
    return df.withColumn("delay_seconds", seconds_between(F.col(event), F.col(processed))).withColumns({
        "is_late_data": delay > 60, "is_very_late_data": delay > 300,
        "delay_category": below(delay, LATE_STEPS, "VERY_LATE", inclusive=True)})


def _watermarked(df: DataFrame, delay: str | None) -> DataFrame:
    return df.withWatermark(TS, delay) if delay and df.isStreaming else df


def lateness_by_type(df: DataFrame, strategy: str = "NO_WATERMARK", size: str = "2 minutes") -> DataFrame:
    """Late-row metrics by type. Without a watermark the state of a stream grows
    without limit, so ``NO_WATERMARK`` is for short runs and comparisons."""
    return windowed(_watermarked(df, WATERMARKS.get(strategy)), size, ["transaction_type"], {
        "transaction_count": rows(), "total_volume": round_half_up(F.sum(USD)),
        "avg_delay_seconds": round_half_up(mean("delay_seconds"), 1),
        "late_data_count": count_when("is_late_data"),
        "very_late_data_count": count_when("is_very_late_data"),
        "max_delay_seconds": F.max("delay_seconds"),
        "earliest_event": F.min(TS), "latest_event": F.max(TS),
    }).withColumn("watermark_strategy", F.lit(strategy))


def lateness_by_place(df: DataFrame, strategy: str = "BALANCED_5min", size: str = "2 minutes") -> DataFrame:
    """Late-row metrics by country and channel."""
    return windowed(_watermarked(df, WATERMARKS.get(strategy)), size, ["country", "channel"], {
        "transaction_count": rows(), "total_volume": round_half_up(F.sum(USD)),
        "avg_amount": round_half_up(mean(USD)),
        "unique_customers": distinct_count(df, "account_id"),
        "late_data_count": count_when("is_late_data"),
        "very_late_data_count": count_when("is_very_late_data"),
        "avg_delay_seconds": round_half_up(mean("delay_seconds"), 1),
        "late_data_pct": percent(count_when("is_late_data"), rows()),
        "window_first_event": F.min(TS), "window_last_event": F.max(TS),
    }).withColumns({
        "time_range": F.concat(F.date_format("window_start", "HH:mm:ss"), F.lit(" - "),
                               F.date_format("window_end", "HH:mm:ss")),
        "watermark_strategy": F.lit(strategy)})


def lateness_overview(df: DataFrame, strategy: str = "RELAXED_1hr", size: str = "10 minutes",
                      known: Mapping[str, Sequence] = NOTHING) -> DataFrame:
    """Share of each delay category and delay percentiles."""
    labels = [label for _, label in LATE_STEPS] + ["VERY_LATE"]
    points = {"median_delay_sec": 0.5, "p95_delay_sec": 0.95, "p99_delay_sec": 0.99}
    return with_percentiles(_watermarked(df, WATERMARKS.get(strategy)), size, "delay_seconds", points, {
        "total_transactions": rows(), "total_volume": round_half_up(F.sum(USD)),
        "unique_customers": distinct_count(df, "account_id"),
        "countries_served": few_distinct(df, "country", known.get("country")),
        **{f"{label.lower()}_pct": percent(count_when(F.col("delay_category") == label), rows())
           for label in labels},
        "avg_delay_sec": round_half_up(mean("delay_seconds"), 1),
    }).withColumns({"start_time": F.date_format("window_start", "HH:mm"),
                    "watermark_strategy": F.lit(strategy)})


def lateness_monitor(df: DataFrame, size: str = "1 minute",
                     processed: str = "processing_timestamp", high_value: int = 1000) -> DataFrame:
    """Delay categories per minute of processing time and their business impact."""
    high = F.col(USD) >= high_value
    return windowed(df, size, ["delay_category"], {
        "event_count": rows(), "avg_delay_seconds": round_half_up(mean("delay_seconds"), 1),
        "min_delay": F.min("delay_seconds"), "max_delay": F.max("delay_seconds"),
        "total_volume": round_half_up(F.sum(USD)),
        "high_value_late_count": count_when(high),
        "high_value_late_volume": round_half_up(sum_when(high, F.col(USD))),
        "high_value_impact_pct": percent(sum_when(high, F.col(USD)), F.sum(USD)),
    }, ts=processed).drop("window_end")
