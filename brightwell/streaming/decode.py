"""From message envelopes to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a transaction message.
TRANSACTION_DDL = """
    transaction_id STRING, account_id STRING, transaction_type STRING, amount DOUBLE,
    currency STRING, merchant STRING, event_time STRING, processing_date STRING,
    location STRUCT<country: STRING, city: STRING>, channel STRING, status STRING,
    metadata STRUCT<ip_address: STRING, device_id: STRING, session_id: STRING>
"""

# The fields of an invoice with nested lines.
INVOICE_DDL = """
    InvoiceNumber STRING, CreatedTime LONG, StoreID STRING, PosID STRING, CustomerType STRING,
    PaymentMethod STRING, DeliveryType STRING,
    DeliveryAddress STRUCT<City: STRING, State: STRING, PinCode: STRING>,
    InvoiceLineItems ARRAY<STRUCT<ItemCode: STRING, ItemDescription: STRING, ItemPrice: DOUBLE,
                                  ItemQty: INT, TotalValue: DOUBLE>>
"""


def decode(messages: DataFrame, schema: str = TRANSACTION_DDL,
           event_time: str = "event_time") -> DataFrame:
    """Envelope (key, value, topic, partition, offset, timestamp) to typed columns.

    Text that is no JSON, and a time that cannot be read, give NULL columns;
    ``dead_letters`` picks those rows.
    """
    # The message becomes columns through a generator: filters on these columns
    # then stay above it, and every message is parsed once. With a plain struct
    # column Spark would repeat the parse inside each pushed-down filter.
    text = F.col("value").cast("string")
    opened = messages.select(
        F.col("key").cast("string").alias("partition_key"),
        F.col("timestamp").alias("kafka_timestamp"), "topic", "partition", "offset",
        text.alias("raw_value"), F.inline(F.array(F.from_json(text, schema))))
    return opened.withColumn("event_timestamp", F.try_to_timestamp(F.col(event_time)))


def flatten_location(df: DataFrame) -> DataFrame:
    """Country and city of a decoded transaction as plain columns."""
    return df.withColumns({"country": F.col("location.country"), "city": F.col("location.city")})


def is_undecodable() -> Column:
    return F.col("transaction_id").isNull() | F.col("event_timestamp").isNull()


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, dead letters with the raw text)."""
    dead = decoded.where(is_undecodable()).select(
        "partition_key", "kafka_timestamp", "topic", "partition", "offset", "raw_value")
    return decoded.where(~is_undecodable()).drop("raw_value"), dead


def transactions(messages: DataFrame) -> DataFrame:
    """Decoded, flattened transactions without the dead letters."""
    return flatten_location(split_decoded(decode(messages))[0])


def invoice_lines(invoices: DataFrame) -> DataFrame:
    """One row per invoice line, address and line fields flattened."""
    return (invoices.select(
        "InvoiceNumber", "CreatedTime", "StoreID", "PosID", "CustomerType", "PaymentMethod",
        "DeliveryType", "DeliveryAddress.City", "DeliveryAddress.State", "DeliveryAddress.PinCode",
        F.explode("InvoiceLineItems").alias("line"))
        .select("*", "line.*").drop("line"))


def encode(df: DataFrame, key: str, columns: list) -> DataFrame:
    """Message form of rows: key and a JSON value."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value"))
