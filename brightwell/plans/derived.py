"""Transactions, log lines and graphs that Spark derives from the given tables.

The rules are plain arithmetic on the keys, so the SQL checks can state them too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.operators.aggregate import dealt, tasks_for
from brightwell.operators.graph import Graph
from brightwell.plans.registry import Tables
from brightwell.streaming import latency, rules

# The vocabulary of the derived columns.
CURRENCIES = ("USD", "EUR", "GBP", "CAD", "AUD")
COUNTRIES = ("US", "CA", "UK", "AU", "DE")
CITIES = ("New York", "Toronto", "London", "Sydney", "Berlin")
CHANNELS = ("online", "atm", "pos", "mobile")
MERCHANTS = tuple(f"merchant_{i}" for i in range(10))
KNOWN = {"country": COUNTRIES, "city": CITIES, "channel": CHANNELS, "merchant": MERCHANTS}
AGENTS = ("Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36",
          "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36 Edg/120.0",
          "Mozilla/5.0 (X11; Linux x86_64) Firefox/121.0",
          "Mozilla/5.0 (Linux; Android 14) Chrome/120.0 Mobile Safari/537.36",
          "Mozilla/5.0 (iPhone; like Mac OS X) Safari/604.1",
          "examplebot/2.1")
REFERRERS = ("-", "https://www.google.com/search?q=x", "https://facebook.com/a/b", "http://news.example.org/7")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def sql_pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{listed}], CAST(({index}) % {len(values)} + 1 AS BIGINT))"


def transactions(events: DataFrame) -> DataFrame:
    """Transactions with three clocks. Account and currency are sometimes
    malformed and one event type is not a valid transaction type."""
    e, u = F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")
    arrival = F.col("ts") + F.make_dt_interval(secs=(e * 37) % 400 - 5)
    return events.select(
        "event_id", e.cast("string").alias("transaction_id"),
        F.when(u % 10 == 0, F.concat(F.lit("AC"), u.cast("string")))
        .otherwise(F.concat(F.lit("ACC"), F.lpad(u.cast("string"), 6, "0"))).alias("account_id"),
        F.when(kind == "click", "transfer").when(kind == "view", "withdrawal")
        .when(kind == "signup", "deposit").otherwise(kind).alias("transaction_type"),
        (F.col("value").cast("decimal(18,2)") * 25).cast("decimal(18,2)").alias("amount"),
        F.when(e % 13 == 0, "usd").otherwise(pick(CURRENCIES, e)).alias("currency"),
        F.when(kind == "purchase", F.concat(F.lit("merchant_"), (e % 10).cast("string"))).alias("merchant"),
        pick(COUNTRIES, u + e).alias("country"), pick(CITIES, e).alias("city"),
        pick(CHANNELS, e).alias("channel"),
        F.col("ts").alias("event_timestamp"), arrival.alias("kafka_timestamp"),
        (arrival + F.make_dt_interval(secs=e % 17)).alias("processing_timestamp"))


SQL_TXN = f"""txn AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS transaction_id,
    CASE WHEN user_id % 10 = 0 THEN 'AC' || CAST(user_id AS VARCHAR)
         ELSE 'ACC' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS account_id,
    CASE event_type WHEN 'click' THEN 'transfer' WHEN 'view' THEN 'withdrawal'
         WHEN 'signup' THEN 'deposit' ELSE event_type END AS transaction_type,
    CAST(CAST(value AS DECIMAL(18,2)) * 25 AS DECIMAL(18,2)) AS amount,
    CASE WHEN event_id % 13 = 0 THEN 'usd' ELSE {sql_pick(CURRENCIES, 'event_id')} END AS currency,
    CASE WHEN event_type = 'purchase' THEN 'merchant_' || CAST(event_id % 10 AS VARCHAR) END AS merchant,
    {sql_pick(COUNTRIES, 'user_id + event_id')} AS country, {sql_pick(CITIES, 'event_id')} AS city,
    {sql_pick(CHANNELS, 'event_id')} AS channel,
    ts AS event_timestamp,
    ts + to_seconds(CAST((event_id * 37) % 400 - 5 AS BIGINT)) AS kafka_timestamp,
    ts + to_seconds(CAST((event_id * 37) % 400 - 5 + event_id % 17 AS BIGINT)) AS processing_timestamp
  FROM events)"""

# The valid-transaction rules, clock at the latest event.
SQL_CHECKED = """checked AS (
  SELECT *, amount > 0 AND amount <= 100000 AS is_valid_amount,
    regexp_matches(currency, '^[A-Z]{3}$') AS is_valid_currency,
    regexp_matches(account_id, '^ACC[0-9]{6}$') AS is_valid_account,
    transaction_type IN ('purchase', 'refund', 'transfer', 'withdrawal', 'deposit') AS is_valid_transaction_type,
    event_timestamp >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS AS is_recent_transaction
  FROM txn)"""


def _sql_rates(preset: str) -> str:
    cases = {"detailed": "WHEN 'EUR' THEN 1.10 WHEN 'GBP' THEN 1.25 WHEN 'CAD' THEN 0.75 WHEN 'AUD' THEN 0.68",
             "basic": "WHEN 'EUR' THEN 1.10 WHEN 'GBP' THEN 1.25",
             "windowed": "WHEN 'EUR' THEN 1.10 WHEN 'GBP' THEN 1.25 WHEN 'CAD' THEN 0.75"}[preset]
    return f"CAST(amount * CAST(CASE currency {cases} ELSE 1 END AS DECIMAL(6,4)) AS DECIMAL(18,4))"


def _sql_fee(preset: str) -> str:
    return {
        "detailed": """CASE WHEN transaction_type = 'transfer' THEN
              CASE WHEN amount <= 1000 THEN 2.50 WHEN amount <= 5000 THEN 5.00 ELSE 10.00 END
            WHEN transaction_type = 'withdrawal' THEN CASE WHEN channel = 'atm' THEN 2.00 ELSE 0 END
            WHEN transaction_type = 'purchase' AND country <> 'US' THEN amount * 0.03 ELSE 0 END""",
        "basic": """CASE WHEN transaction_type = 'transfer' THEN CASE WHEN amount <= 1000 THEN 2.50 ELSE 5.00 END
            WHEN transaction_type = 'withdrawal' THEN 2.00 ELSE 0 END""",
        "windowed": "CASE transaction_type WHEN 'transfer' THEN 5.00 WHEN 'withdrawal' THEN 2.00 ELSE 0 END",
    }[preset]


def sql_enriched(preset: str) -> str:
    """CTEs ``txn``, ``checked`` ... ``enriched`` for one rule set."""
    good = "is_valid_amount AND is_valid_currency AND is_valid_account AND is_valid_transaction_type"
    if preset == "detailed":
        good += " AND is_recent_transaction"
    high = {"detailed": 5000, "basic": 5000, "windowed": 1000}[preset]
    extended = """
        + CASE WHEN is_late_night OR is_weekend THEN 15 ELSE 0 END
        + CASE WHEN transaction_type IN ('withdrawal', 'transfer') THEN 10 ELSE 0 END
        + CASE WHEN NOT overall_data_quality THEN 30 ELSE 0 END""" if preset == "detailed" else ""
    levels = ("WHEN risk_score >= 70 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MEDIUM' "
              "WHEN risk_score >= 20 THEN 'LOW' ELSE 'MINIMAL'" if preset == "detailed" else
              "WHEN risk_score >= 40 THEN 'HIGH' WHEN risk_score >= 20 THEN 'MEDIUM' ELSE 'LOW'")
    return f"""{SQL_TXN}, {SQL_CHECKED}, amounts AS (
      SELECT *, COALESCE({good}, FALSE) AS overall_data_quality,
        CAST({_sql_fee(preset)} AS DECIMAL(18,4)) AS transaction_fee,
        CAST(CASE WHEN transaction_type = 'purchase' THEN amount * CAST(CASE country WHEN 'US' THEN 0.08
             WHEN 'CA' THEN 0.13 WHEN 'UK' THEN 0.20 ELSE 0.10 END AS DECIMAL(6,4)) ELSE 0 END
             AS DECIMAL(18,4)) AS tax_amount,
        {_sql_rates(preset)} AS amount_usd,
        hour(event_timestamp) AS transaction_hour, dayofweek(event_timestamp) + 1 AS transaction_day_of_week,
        dayofweek(event_timestamp) IN (0, 6) AS is_weekend,
        hour(event_timestamp) >= 23 OR hour(event_timestamp) <= 6 AS is_late_night
      FROM checked), scored AS (
      SELECT *, amount_usd >= {high} AS is_high_value, country <> 'US' AS is_international,
        CASE WHEN amount_usd >= {high} THEN 25 ELSE 0 END + CASE WHEN country <> 'US' THEN 20 ELSE 0 END
        + CASE WHEN channel = 'online' THEN 10 ELSE 0 END{extended} AS risk_score
      FROM amounts), enriched AS (
      SELECT *, CASE {levels} END AS risk_level FROM scored)"""


def latest_event(t: Tables) -> Column:
    """The clock of the recency rule: a scalar subquery, not a value on the driver."""
    return t.events.agg(F.max("ts")).scalar()


def enriched(t: Tables, preset: str) -> DataFrame:
    return rules.enrich(transactions(t.events), rules.PRESETS[preset], latest_event(t))


def windowed_input(t: Tables) -> DataFrame:
    """Input of the window reports: positive amounts, the windowed rule set."""
    return enriched(t, "windowed").where("amount > 0")


SQL_WINDOWED = sql_enriched("windowed") + ", t AS (SELECT * FROM enriched WHERE amount > 0)"


def with_delays(t: Tables) -> DataFrame:
    return latency.add_delays(transactions(t.events))


SQL_SECONDS = "CAST(floor(epoch({later})) - floor(epoch({earlier})) AS BIGINT)"
SQL_DELAYS = f"""{SQL_TXN}, gaps AS (
  SELECT *, {SQL_SECONDS.format(earlier='event_timestamp', later='kafka_timestamp')} AS ingestion_delay_seconds,
    {SQL_SECONDS.format(earlier='event_timestamp', later='processing_timestamp')} AS processing_delay_seconds,
    {SQL_SECONDS.format(earlier='kafka_timestamp', later='processing_timestamp')} AS hop_delay_seconds
  FROM txn), t AS (
  SELECT *, ingestion_delay_seconds > 30 AS is_late_arriving, ingestion_delay_seconds > 300 AS is_very_late,
    event_timestamp > processing_timestamp AS is_future_event,
    CASE WHEN ingestion_delay_seconds < 0 THEN 'FUTURE' WHEN ingestion_delay_seconds <= 5 THEN 'IMMEDIATE'
      WHEN ingestion_delay_seconds <= 30 THEN 'QUICK' WHEN ingestion_delay_seconds <= 300 THEN 'DELAYED'
      ELSE 'VERY_LATE' END AS delay_category
  FROM gaps)"""


def with_lateness(t: Tables) -> DataFrame:
    return latency.add_lateness(windowed_input(t))


SQL_LATENESS = SQL_WINDOWED.replace(", t AS (", ", base AS (") + f""", gaps AS (
  SELECT *, {SQL_SECONDS.format(earlier='event_timestamp', later='processing_timestamp')} AS delay_seconds
  FROM base), late AS (
  SELECT *, delay_seconds > 60 AS is_late_data, delay_seconds > 300 AS is_very_late_data,
    CASE WHEN delay_seconds <= 5 THEN 'IMMEDIATE' WHEN delay_seconds <= 30 THEN 'QUICK'
      WHEN delay_seconds <= 60 THEN 'NORMAL' WHEN delay_seconds <= 300 THEN 'LATE'
      ELSE 'VERY_LATE' END AS delay_category
  FROM gaps)"""


def log_lines(events: DataFrame) -> DataFrame:
    """One combined-format log line per event; every 101st is broken."""
    e, u = F.col("event_id"), F.col("user_id")
    line = F.concat(
        F.lit("10.0."), F.floor(u / 256).cast("string"), F.lit("."), (u % 256).cast("string"),
        F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""),
        pick(("GET", "GET", "POST"), e), F.lit(" "), pick(("/home", "/login", "/item/7", "/admin/x"), e + u),
        F.lit(" HTTP/1.1\" "), pick(("200", "200", "301", "404", "500"), e), F.lit(" "),
        F.when(e % 11 == 0, "-").otherwise((e % 5000).cast("string")), F.lit(" \""),
        pick(REFERRERS, e), F.lit("\" \""), pick(AGENTS, e), F.lit("\""))
    return events.select(F.when(e % 101 == 0, "broken line").otherwise(line).alias("value"))


# The same fields without going through text: what the parser must find.
SQL_LOGS = f"""logs AS (
  SELECT '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
    date_trunc('second', ts) AS ts, {sql_pick(('GET', 'GET', 'POST'), 'event_id')} AS method,
    {sql_pick(('/home', '/login', '/item/7', '/admin/x'), 'event_id + user_id')} AS request,
    {sql_pick(('200', '200', '301', '404', '500'), 'event_id')} AS status,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 5000 END AS size_bytes,
    {sql_pick(REFERRERS, 'event_id')} AS referrer, {sql_pick(AGENTS, 'event_id')} AS user_agent,
    event_id % 101 = 0 AS broken
  FROM events), good AS (SELECT * FROM logs WHERE NOT broken)"""


def place_graph(t: Tables) -> Graph:
    """Customers and suppliers point to nations, nations to regions."""
    def node(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))
    vertices = (
        t.customer.select(node("C", "c_custkey").alias("id"), F.col("c_name").alias("name"))
        .unionByName(t.supplier.select(node("S", "s_suppkey").alias("id"), F.col("s_name").alias("name")))
        .unionByName(t.nation.select(node("N", "n_nationkey").alias("id"), F.col("n_name").alias("name")))
        .unionByName(t.region.select(node("R", "r_regionkey").alias("id"), F.col("r_name").alias("name"))))
    edges = (
        t.customer.select(node("C", "c_custkey").alias("src"), node("N", "c_nationkey").alias("dst"))
        .unionByName(t.supplier.select(node("S", "s_suppkey").alias("src"), node("N", "s_nationkey").alias("dst")))
        .unionByName(t.nation.select(node("N", "n_nationkey").alias("src"), node("R", "n_regionkey").alias("dst"))))
    return Graph(vertices, edges)


SQL_PLACES = """vertices AS (
  SELECT 'C' || c_custkey AS id, c_name AS name FROM customer
  UNION ALL SELECT 'S' || s_suppkey, s_name FROM supplier
  UNION ALL SELECT 'N' || n_nationkey, n_name FROM nation
  UNION ALL SELECT 'R' || r_regionkey, r_name FROM region), edges AS (
  SELECT 'C' || c_custkey AS src, 'N' || c_nationkey AS dst FROM customer
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey FROM supplier
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation)"""


def trade_graph(t: Tables) -> Graph:
    """Customers point to the suppliers they bought from; both point to their nation."""
    def node(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))
    # Pairs are compared as numbers, once: few lines of an order share a supplier.
    pairs = (t.lineitem.select("l_orderkey", "l_suppkey")
             .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
             .select("o_custkey", "l_suppkey"))
    bought = dealt(pairs, ["o_custkey", "l_suppkey"], tasks_for(t.lineitem)).distinct().select(
        node("C", "o_custkey").alias("src"), node("S", "l_suppkey").alias("dst"))
    places = place_graph(t)
    homes = places.edges.where("src NOT LIKE 'N%'")
    return Graph(places.vertices.where("id NOT LIKE 'R%'"), bought.unionByName(homes))


SQL_TRADE = SQL_PLACES.replace("vertices AS", "all_vertices AS").replace("edges AS", "all_edges AS") + """,
  vertices AS (SELECT * FROM all_vertices WHERE id NOT LIKE 'R%'), edges AS (
  SELECT DISTINCT 'C' || o_custkey AS src, 'S' || l_suppkey AS dst
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  UNION ALL SELECT * FROM all_edges WHERE src NOT LIKE 'N%')"""
