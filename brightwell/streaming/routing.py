"""Split streams by quality and risk, and the summaries sent downstream."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.functions.numbers import mean, round_half_up
from brightwell.streaming.decode import encode
from brightwell.streaming.windows import windowed


class Routes(NamedTuple):
    valid: DataFrame
    invalid: DataFrame
    high_risk: DataFrame


def route(df: DataFrame) -> Routes:
    """Every row is valid or invalid (NULL quality is invalid); high-risk rows
    are a further view of the same input."""
    good = F.coalesce(F.col("overall_data_quality"), F.lit(False))
    return Routes(df.where(good), df.where(~good), df.where(F.col("risk_level") == "HIGH"))


def route_counts(df: DataFrame) -> DataFrame:
    """Rows per route and risk level."""
    good = F.coalesce(F.col("overall_data_quality"), F.lit(False))
    return df.groupBy(F.when(good, "valid").otherwise("invalid").alias("route"), "risk_level").agg(
        F.count(F.lit(1)).alias("n_rows"))


def fraud_alerts(high_risk: DataFrame) -> DataFrame:
    """Alert messages keyed by account."""
    return encode(high_risk, "account_id", [
        "transaction_id", "account_id", "amount_usd", "risk_score", "risk_level", "country",
        F.col("event_timestamp").cast("string").alias("alert_time")])


def account_summary(valid: DataFrame, size: str = "1 minute") -> DataFrame:
    """Per account and window: count, dollars, mean risk, last time."""
    return windowed(valid, size, ["account_id"], {
        "transaction_count": F.count(F.lit(1)),
        "total_amount_usd": F.sum("amount_usd").cast("double"),
        "avg_risk_score": round_half_up(mean("risk_score")),
        "last_transaction_time": F.max("event_timestamp")})


def account_messages(summary: DataFrame) -> DataFrame:
    return encode(summary, "account_id", [
        "account_id", "window_start", "window_end", "transaction_count", "total_amount_usd",
        "avg_risk_score", F.col("last_transaction_time").cast("string").alias("last_transaction_time")])


def type_risk_statistics(valid: DataFrame, size: str = "30 seconds") -> DataFrame:
    return windowed(valid, size, ["transaction_type", "risk_level"], {
        "count": F.count(F.lit(1)),
        "avg_amount_usd": round_half_up(mean("amount_usd")),
        "total_amount_usd": round_half_up(F.sum("amount_usd"))}).drop("window_end")


def invalid_monitor(invalid: DataFrame, size: str = "1 minute") -> DataFrame:
    """Invalid rows per window by the rule they break (NULL flags included)."""
    def broken(flag):
        return F.count_if(~F.coalesce(F.col(flag), F.lit(False)))
    return windowed(invalid, size, [], {
        "invalid_count": F.count(F.lit(1)), "invalid_amounts": broken("is_valid_amount"),
        "invalid_currencies": broken("is_valid_currency"),
        "invalid_accounts": broken("is_valid_account")}).drop("window_end")
