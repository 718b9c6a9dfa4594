"""Validation, enrichment and risk rules for transactions.

Each function adds columns to a table or stream with the columns
transaction_type, amount, currency, country, channel, account_id and
event_timestamp. The rule values are data: pass another ``Rules`` to change them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.functions.bands import at_least, first_match, points
from brightwell.functions.dates import is_weekend, seconds_between
from brightwell.functions.numbers import money

# What a valid transaction looks like.
VALID_TYPES = ("purchase", "refund", "transfer", "withdrawal", "deposit")
CURRENCY_PATTERN = "^[A-Z]{3}$"
ACCOUNT_PATTERN = "^ACC[0-9]{6}$"
MAX_AMOUNT = 100_000
RECENT = "24 HOURS"
HOME_COUNTRY = "US"


@dataclass(frozen=True)
class Rules:
    """One set of fee, rate and risk values."""

    rates: Mapping[str, str]
    transfer_fees: Sequence[tuple[int, str]]      # (amount up to, fee)
    transfer_fee_above: str
    withdrawal_fees: Mapping[str, str]            # by channel; "*" is any channel
    purchase_abroad_fee: str                      # share of the amount
    high_amount: int
    level_steps: Sequence[tuple[int, str]]
    level_lowest: str
    extended_risk: bool                           # also time, cash and quality points


# The four rule sets. "detailed" is the default.
DETAILED = Rules(
    rates={"USD": "1", "EUR": "1.10", "GBP": "1.25", "CAD": "0.75", "AUD": "0.68"},
    transfer_fees=((1000, "2.50"), (5000, "5.00")), transfer_fee_above="10.00",
    withdrawal_fees={"atm": "2.00"}, purchase_abroad_fee="0.03", high_amount=5000,
    level_steps=((70, "HIGH"), (40, "MEDIUM"), (20, "LOW")), level_lowest="MINIMAL", extended_risk=True)
BASIC = Rules(
    rates={"USD": "1", "EUR": "1.10", "GBP": "1.25"},
    transfer_fees=((1000, "2.50"),), transfer_fee_above="5.00",
    withdrawal_fees={"*": "2.00"}, purchase_abroad_fee="0", high_amount=5000,
    level_steps=((40, "HIGH"), (20, "MEDIUM")), level_lowest="LOW", extended_risk=False)
WINDOWED = Rules(
    rates={"USD": "1", "EUR": "1.10", "GBP": "1.25", "CAD": "0.75"},
    transfer_fees=(), transfer_fee_above="5.00",
    withdrawal_fees={"*": "2.00"}, purchase_abroad_fee="0", high_amount=1000,
    level_steps=((40, "HIGH"), (20, "MEDIUM")), level_lowest="LOW", extended_risk=False)
PRESETS = {"detailed": DETAILED, "basic": BASIC, "windowed": WINDOWED}

# Tax on purchases by country, and elsewhere.
PURCHASE_TAX = {"US": "0.08", "CA": "0.13", "UK": "0.20"}
PURCHASE_TAX_ELSEWHERE = "0.10"


def _exact(text: str) -> Column:
    return F.lit(Decimal(text)).cast("decimal(6,4)")


def validate(df: DataFrame, as_of: Column | None = None, check_recency: bool = True) -> DataFrame:
    """Add one flag per rule and their conjunction.

    ``as_of`` is the clock for the recency rule; a fixed one makes a batch run
    repeatable. A NULL flag counts as false in the conjunction, so every row is
    either valid or invalid.
    """
    flags = {
        "is_valid_amount": (F.col("amount") > 0) & (F.col("amount") <= MAX_AMOUNT),
        "is_valid_currency": F.col("currency").rlike(CURRENCY_PATTERN),
        "is_valid_account": F.col("account_id").rlike(ACCOUNT_PATTERN),
        "is_valid_transaction_type": F.col("transaction_type").isin(*VALID_TYPES),
    }
    if check_recency:
        now = F.current_timestamp() if as_of is None else as_of
        flags["is_recent_transaction"] = F.col("event_timestamp") >= now - F.expr(f"INTERVAL {RECENT}")
    overall = F.lit(True)
    for name in flags:
        overall = overall & F.coalesce(F.col(name), F.lit(False))
    return df.withColumns(flags).withColumn("overall_data_quality", overall)


def usd_amount(rules: Rules = DETAILED) -> Column:
    """Amount in dollars; an unknown currency keeps its amount."""
    rate = first_match(
        [(F.col("currency") == code, _exact(value)) for code, value in rules.rates.items()], _exact("1"))
    return money("amount") * rate


def add_amounts(df: DataFrame, rules: Rules = DETAILED) -> DataFrame:
    """Fee, tax, net amount and dollar amount, as exact decimals."""
    amount = money("amount")
    kind, channel = F.col("transaction_type"), F.col("channel")
    abroad = F.col("country") != HOME_COUNTRY
    zero = _exact("0")
    transfer_fee = first_match(
        [(F.col("amount") <= limit, _exact(fee)) for limit, fee in rules.transfer_fees],
        _exact(rules.transfer_fee_above))
    withdrawal_fee = first_match(
        [(F.lit(True) if name == "*" else channel == name, _exact(fee))
         for name, fee in rules.withdrawal_fees.items()], zero)
    fee = first_match(
        [(kind == "transfer", transfer_fee.cast("decimal(18,4)")),
         (kind == "withdrawal", withdrawal_fee.cast("decimal(18,4)")),
         ((kind == "purchase") & abroad,
          (amount * _exact(rules.purchase_abroad_fee)).cast("decimal(18,4)"))],
        zero.cast("decimal(18,4)"))
    tax_rate = first_match(
        [(F.col("country") == place, _exact(rate)) for place, rate in PURCHASE_TAX.items()],
        _exact(PURCHASE_TAX_ELSEWHERE))
    tax = F.when(kind == "purchase", (amount * tax_rate).cast("decimal(18,4)")).otherwise(
        zero.cast("decimal(18,4)"))
    return df.withColumns({
        "transaction_fee": fee, "tax_amount": tax, "amount_usd": usd_amount(rules).cast("decimal(18,4)"),
    }).withColumn("net_amount", amount + F.col("transaction_fee") + F.col("tax_amount"))


def add_time_fields(df: DataFrame, opens: int = 9, closes: int = 17, night_from: int = 23,
                    night_to: int = 6) -> DataFrame:
    """Hour, weekday, month and the time flags. Hour limits are inclusive."""
    ts = F.col("event_timestamp")
    hour = F.hour(ts)
    added = {
        "transaction_hour": hour, "transaction_day_of_week": F.dayofweek(ts),
        "transaction_month": F.month(ts), "is_weekend": is_weekend(ts),
        "is_business_hours": ~is_weekend(ts) & hour.between(opens, closes),
        "is_late_night": (hour >= night_from) | (hour <= night_to),
    }
    if "kafka_timestamp" in df.columns:
        added["processing_delay_seconds"] = seconds_between(ts, F.col("kafka_timestamp"))
    return df.withColumns(added)


def add_risk(df: DataFrame, rules: Rules = DETAILED) -> DataFrame:
    """Risk flags, additive score and level. Needs the columns of ``add_amounts``
    and, for the extended rules, of ``add_time_fields`` and ``validate``."""
    flags = {
        "is_high_value": F.col("amount_usd") >= rules.high_amount,
        "is_international": F.col("country") != HOME_COUNTRY,
    }
    score = [(F.col("is_high_value"), 25), (F.col("is_international"), 20),
             (F.col("channel") == "online", 10)]
    if rules.extended_risk:
        flags |= {
            "is_unusual_time": F.col("is_late_night") | F.col("is_weekend"),
            "is_cash_equivalent": F.col("transaction_type").isin("withdrawal", "transfer"),
        }
        score += [(F.col("is_unusual_time"), 15), (F.col("is_cash_equivalent"), 10),
                  (~F.col("overall_data_quality"), 30)]
    return df.withColumns(flags).withColumn("risk_score", points(score)).withColumn(
        "risk_level", at_least(F.col("risk_score"), rules.level_steps, rules.level_lowest))


def enrich(df: DataFrame, rules: Rules = DETAILED, as_of: Column | None = None) -> DataFrame:
    """All rules in order."""
    checked = validate(df, as_of, check_recency=rules.extended_risk)
    return add_risk(add_time_fields(add_amounts(checked, rules)), rules)


def with_rate_table(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Dollar amounts from a rate table (currency, rate) joined to a table or stream.

    A missing rate keeps the amount. The rate table is broadcast after its
    size is checked.
    """
    from brightwell.operators.relational import lookup
    joined = lookup(df, rates, "currency", "currency", {"__rate": "rate"})
    return joined.withColumn(
        "amount_usd",
        (money("amount") * F.coalesce(F.col("__rate").cast("decimal(6,4)"), _exact("1")))
        .cast("decimal(18,4)")).drop("__rate")
