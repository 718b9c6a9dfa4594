"""Web-server log analysis (combined log format)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.functions.bands import first_match
from brightwell.functions.numbers import percent
from brightwell.functions.strings import url_origin

# The eleven groups of a combined log line. The referrer may be
# empty or hold blanks; the line must close the user-agent quote.
LOG_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" '
    r'(\d{3}) (\S+) "([^"]*)" "([^"]*)"'
)
LOG_FIELDS = {"ip": 1, "date": 4, "method": 5, "request": 6, "status": 8,
              "size": 9, "referrer": 10, "user_agent": 11}
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Marks in the user agent, special names before general ones.
BROWSERS = (("Edg", "Edge"), ("Chrome", "Chrome"), ("Firefox", "Firefox"),
            ("Safari", "Safari"), ("Mozilla", "Mozilla"))
SYSTEMS = (("Windows", "Windows"), ("Android", "Android"), ("iPhone", "iOS"), ("iOS", "iOS"),
           ("Macintosh", "MacOS"), ("Linux", "Linux"))
# The general-first order, for comparison with older reports.
BROWSERS_GENERAL_FIRST = (("Chrome", "Chrome"), ("Firefox", "Firefox"), ("Safari", "Safari"),
                          ("Edge", "Edge"), ("Mozilla", "Mozilla"))
SYSTEMS_GENERAL_FIRST = (("Windows", "Windows"), ("Macintosh", "MacOS"), ("Linux", "Linux"),
                         ("Android", "Android"), ("iOS", "iOS"))
REFERRER_TYPES = (("google", "Search Engine"), ("facebook", "Social Media"),
                  ("twitter", "Social Media"))
SUSPICIOUS_REQUESTS = ("admin", "login", "password", "..")
SUSPICIOUS_AGENTS = ("bot", "crawl")
STATUS_CLASSES = (("2", "Success"), ("3", "Redirect"), ("4", "Client Error"), ("5", "Server Error"))


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Eight fields of each line; all empty when the line does not match."""
    return lines.select(*[
        F.regexp_extract(column, LOG_PATTERN, group).alias(name)
        for name, group in LOG_FIELDS.items()])


def parse_report(logs: DataFrame) -> DataFrame:
    """Success rate and empty fields, in one pass."""
    return logs.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("ip") != "").alias("parsed_records"),
        percent(F.count_if(F.col("ip") != ""), F.count(F.lit(1)), 2).alias("success_rate"),
        *[F.count_if(F.col(name) == "").alias(f"empty_{name}")
          for name in ("ip", "date", "method", "status")])


def marked(text: Column, marks, otherwise: str) -> Column:
    """Label of the first mark the text contains."""
    return first_match([(F.contains(text, F.lit(mark)), label) for mark, label in marks], otherwise)


def status_class(status: Column) -> Column:
    return first_match([(F.startswith(status, F.lit(d)), label) for d, label in STATUS_CLASSES],
                       "Unknown")


def _count_by(df: DataFrame, *keys, name: str = "request_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def by_method(logs: DataFrame) -> DataFrame:
    return _count_by(logs, "method")


def by_status(logs: DataFrame) -> DataFrame:
    return _count_by(logs, "status", name="count").withColumn(
        "status_category", status_class(F.col("status")))


def by_ip(logs: DataFrame) -> DataFrame:
    return _count_by(logs, "ip")


def error_endpoints(logs: DataFrame, first_error: int = 400) -> DataFrame:
    failed = logs.where(F.col("status").try_cast("int") >= first_error)
    return _count_by(failed, "status", "request", name="error_count")


def referrers(logs: DataFrame) -> DataFrame:
    """Referring sites with their kind; blank and "-" referrers left out."""
    text = F.col("referrer")
    return _count_by(
        logs.where(~F.trim(text).isin("-", "")),
        marked(text, REFERRER_TYPES, "Other Website").alias("referrer_type"),
        url_origin(text).alias("referrer_domain"), name="referral_count")


def by_browser(logs: DataFrame, marks=BROWSERS) -> DataFrame:
    return _count_by(logs, marked(F.col("user_agent"), marks, "Other").alias("browser"),
                     name="usage_count")


def by_system(logs: DataFrame, marks=SYSTEMS) -> DataFrame:
    return _count_by(logs, marked(F.col("user_agent"), marks, "Other").alias("os"), name="count")


def with_log_time(logs: DataFrame) -> DataFrame:
    """Adds the parsed time; lines without a valid time are left out."""
    return (logs.withColumn("parsed_timestamp",
                            F.try_to_timestamp(F.col("date"), F.lit(LOG_TIME_FORMAT)))
            .where(F.col("parsed_timestamp").isNotNull()))


def hourly_traffic(df: DataFrame, ts: str) -> DataFrame:
    return _count_by(df, F.hour(ts).alias("hour"), name="requests")


def weekday_traffic(df: DataFrame, ts: str) -> DataFrame:
    return _count_by(df, F.date_format(ts, "EEEE").alias("day_name"),
                     F.dayofweek(ts).alias("day_of_week"), name="requests")


def response_sizes(logs: DataFrame) -> DataFrame:
    """Size statistics by status for lines whose size is a number."""
    sized = (logs.withColumn("size_bytes", F.col("size").try_cast("long"))
             .where(F.col("size_bytes").isNotNull()))
    return sized.groupBy("status").agg(
        F.count(F.lit(1)).alias("request_count"), F.avg("size_bytes").alias("avg_response_size"),
        F.max("size_bytes").alias("max_response_size"), F.sum("size_bytes").alias("total_bytes"))


def suspicious(logs: DataFrame) -> DataFrame:
    """Requests with probing marks, or from robots, by request and status."""
    condition = F.lit(False)
    for mark in SUSPICIOUS_REQUESTS:
        condition = condition | F.contains(F.col("request"), F.lit(mark))
    for mark in SUSPICIOUS_AGENTS:
        condition = condition | F.contains(F.col("user_agent"), F.lit(mark))
    return _count_by(logs.where(condition), "request", "status", name="count")
