"""Scans, projections, filters, joins, set operations and top-n."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightwell.functions.bands import DISCOUNT_TIERS, below
from brightwell.functions.dates import widen_year
from brightwell.functions.numbers import mean, money, n_rows, total
from brightwell.operators import relational as rel
from brightwell.operators.aggregate import completion_rates
from brightwell.plans import derived
from brightwell.plans.registry import SQL_REVENUE, query, sql_count, sql_mean, sql_money, sql_total
from brightwell.sources import files
from brightwell.streaming import decode



def revenue(prefix: str = "l_"):
    """Discounted price as DECIMAL(18,4), which Spark keeps in a long."""
    return F.col(f"{prefix}extendedprice").cast("decimal(12,2)") * (
        1 - F.col(f"{prefix}discount").cast("decimal(4,2)"))


@query("filter_group_count", """
SELECT c_mktsegment, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice > 250000 GROUP BY c_mktsegment""")
def filter_group_count(t):
    # Counted per customer first: the join then meets one row per customer.
    per_customer = (t.orders.where(F.col("o_totalprice") > 250000)
                    .groupBy("o_custkey").agg(n_rows().alias("n")))
    return (per_customer.join(t.customer.select("c_custkey", "c_mktsegment"),
                              F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_mktsegment").agg(F.sum("n").alias("n_orders")))


@query("json_props_scan", """
SELECT event_type, count(*) AS n_events, CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS sum_k,
  max(CAST(json_extract_string(props, '$.k') AS INT)) AS max_k
FROM events GROUP BY event_type""")
def json_props_scan(t):
    k = F.from_json("props", "k INT")["k"]
    return t.events.groupBy("event_type").agg(
        n_rows().alias("n_events"), F.sum(k).alias("sum_k"), F.max(k).alias("max_k"))


@query("range_category", """
WITH ids AS (SELECT unnest(range(lo, hi + 1)) AS id
             FROM (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders))
SELECT CASE WHEN id % 3 = 0 THEN 'Premium' WHEN id % 3 = 1 THEN 'Standard' ELSE 'Basic' END AS category,
  count(*) AS n_ids, CAST(sum(id * 2) AS BIGINT) AS sum_value, count(o_orderkey) AS n_orders
FROM ids LEFT JOIN orders ON id = o_orderkey GROUP BY 1""")
def range_category(t):
    # The range covers the order keys, so the generated rows grow with the table.
    lo, hi = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    ids = files.with_range_category(files.number_range(t.spark, lo, hi))
    return (ids.join(t.orders.select("o_orderkey"), F.col("id") == F.col("o_orderkey"), "left")
            .groupBy("category").agg(n_rows().alias("n_ids"), F.sum("value").alias("sum_value"),
                                     F.count("o_orderkey").alias("n_orders")))


@query("select_nested", "SELECT event_id, user_id, event_type, value, ts FROM events")
def select_nested(t):
    nested = t.events.select(
        "event_id", F.struct("user_id", "event_type").alias("who"), F.struct("value", "ts").alias("what"))
    return nested.select("event_id", "who.*", "what.value", F.col("what.ts").alias("ts"))


@query("events_json_decode", f"""
WITH {derived.SQL_TXN}
SELECT transaction_id, account_id, transaction_type, CAST(amount AS DOUBLE) AS amount, currency, country, city,
  channel, event_timestamp FROM txn WHERE event_id % 50 <> 0""")
def events_json_decode(t):
    txn = derived.transactions(t.events)
    location = F.struct("country", "city").alias("location")
    messages = decode.encode(
        txn.withColumn("event_time", F.col("event_timestamp").cast("string")), "account_id",
        ["transaction_id", "account_id", "transaction_type", "amount", "currency", "event_time",
         location, "channel"])
    # Every 50th message is broken on the way and must be dropped as a dead letter.
    envelope = messages.select(
        "key",
        F.when(F.get_json_object("value", "$.transaction_id").cast("long") % 50 == 0, F.lit("{broken"))
        .otherwise(F.col("value")).alias("value"),
        F.lit("transactions").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"))
    return decode.transactions(envelope).select(
        "transaction_id", "account_id", "transaction_type", "amount", "currency", "country", "city",
        "channel", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"))


@query("kafka_encode", f"""
WITH {derived.SQL_TXN}
SELECT account_id AS key, transaction_id, CAST(amount AS DOUBLE) AS amount, country, channel FROM txn""")
def kafka_encode(t):
    messages = decode.encode(derived.transactions(t.events), "account_id",
                             ["transaction_id", "amount", "country", "channel"])
    fields = F.from_json("value", "transaction_id STRING, amount DOUBLE, country STRING, channel STRING")
    return messages.select("key", fields.alias("v")).select("key", "v.*")


@query("discount_tier", f"""
SELECT CASE WHEN l_discount < 0.03 THEN 'Low' WHEN l_discount < 0.07 THEN 'Medium' ELSE 'High' END AS discount_tier,
  count(*) AS orders, {sql_mean(sql_money('l_quantity'))} AS avg_quantity
FROM lineitem GROUP BY 1""")
def discount_tier(t):
    tiered = t.lineitem.selectExpr(
        "CASE WHEN l_discount < 0.03 THEN 'Low' WHEN l_discount < 0.07 THEN 'Medium' ELSE 'High' END "
        "AS discount_tier", "l_quantity")
    return tiered.groupBy("discount_tier").agg(
        n_rows().alias("orders"), mean(money("l_quantity")).alias("avg_quantity"))


@query("order_amounts", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST({SQL_REVENUE} AS DOUBLE) AS discounted_price,
  CAST(({SQL_REVENUE}) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS total_amount FROM lineitem""")
def order_amounts(t):
    priced = t.lineitem.withColumn("price", revenue()).withColumn(
        "total", F.col("price") * (1 + F.col("l_tax").cast("decimal(4,2)")))
    return priced.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         F.col("price").cast("double").alias("discounted_price"),
                         F.col("total").cast("double").alias("total_amount"))


@query("filter_boolean", f"""
SELECT l_returnflag, count(*) AS n_rows, {sql_total(sql_money('l_quantity'))} AS sum_qty FROM lineitem
WHERE (l_quantity > 30 AND l_discount >= 0.05) OR NOT (l_returnflag = 'N') GROUP BY l_returnflag""")
def filter_boolean(t):
    wanted = ((F.col("l_quantity") > 30) & (F.col("l_discount") >= 0.05)) | ~(F.col("l_returnflag") == "N")
    return t.lineitem.where(wanted).groupBy("l_returnflag").agg(
        n_rows().alias("n_rows"), total(money("l_quantity")).alias("sum_qty"))


@query("filter_between", f"""
SELECT l_linestatus, count(*) AS n_rows, {sql_total(sql_money('l_extendedprice'))} AS sum_price FROM lineitem
WHERE l_quantity BETWEEN 10 AND 20 AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
GROUP BY l_linestatus""")
def filter_between(t):
    shipped = t.lineitem.where(
        F.col("l_quantity").between(10, 20)
        & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return shipped.groupBy("l_linestatus").agg(
        n_rows().alias("n_rows"), total(money("l_extendedprice")).alias("sum_price"))


@query("filter_in", """
SELECT o_orderpriority, o_orderstatus, count(*) AS n_orders FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('O', 'P') GROUP BY ALL""")
def filter_in(t):
    return (t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .where("o_orderstatus IN ('O', 'P')")
            .groupBy("o_orderpriority", "o_orderstatus").agg(n_rows().alias("n_orders")))


@query("case_bands", """
SELECT CASE WHEN p_size < 10 THEN 'Small' WHEN p_size < 30 THEN 'Medium' ELSE 'Large' END AS size_band,
  CASE WHEN p_retailprice > 1000 THEN CASE WHEN p_size > 25 THEN 'Bulky premium' ELSE 'Premium' END
       ELSE 'Standard' END AS offer, count(*) AS n_parts FROM part GROUP BY ALL""")
def case_bands(t):
    size = F.col("p_size")
    offer = F.when(F.col("p_retailprice") > 1000, F.when(size > 25, "Bulky premium").otherwise("Premium")
                   ).otherwise("Standard")
    return t.part.groupBy(below(size, ((10, "Small"), (30, "Medium")), "Large").alias("size_band"),
                          offer.alias("offer")).agg(n_rows().alias("n_parts"))


@query("cast_ints", """
SELECT page_id, string_split(url, '/')[5] AS segment, TRY_CAST(string_split(url, '/')[5] AS INTEGER) AS number
FROM pages""")
def cast_ints(t):
    segment = F.get(F.split("url", "/"), 4)
    return t.pages.select("page_id", segment.alias("segment"), segment.try_cast("int").alias("number"))


@query("year_standardise", """
SELECT y2, CAST(CASE WHEN y2 < 20 THEN y2 + 2000 WHEN y2 < 100 THEN y2 + 1900 ELSE y2 END AS INT) AS year,
  count(*) AS n_orders
FROM (SELECT CAST(CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate) ELSE year(o_orderdate) % 100 END AS INT) AS y2
      FROM orders) GROUP BY ALL""")
def year_standardise(t):
    year = F.year("o_orderdate")
    short = t.orders.select(F.when(F.col("o_orderkey") % 3 == 0, year).otherwise(year % 100).alias("y2"))
    return short.groupBy("y2", widen_year(F.col("y2")).alias("year")).agg(n_rows().alias("n_orders"))


@query("top_n_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def top_n_orders(t):
    return rel.top_n(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 100,
                     F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("id_and_rand", """
SELECT l_orderkey % 64 AS bucket, count(*) AS n_rows, count(*) AS n_ids, TRUE AS in_range FROM lineitem GROUP BY 1""")
def id_and_rand(t):
    # Ids are unique and numbers stay in their range; the values themselves differ by layout.
    marked = rel.with_random(rel.with_surrogate_id(t.lineitem.select("l_orderkey")), "score")
    return marked.groupBy((F.col("l_orderkey") % 64).alias("bucket")).agg(
        n_rows().alias("n_rows"), F.count_distinct("id").alias("n_ids"),
        F.bool_and((F.col("score") >= 0) & (F.col("score") < 100)).alias("in_range"))


@query("join_inner", f"""
SELECT o_orderpriority, c_mktsegment, count(*) AS n_orders, {sql_total(sql_money('o_totalprice'))} AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def join_inner(t):
    # Partial sums per (customer, priority) go through the join, not every order.
    per_customer = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        n_rows().alias("n"), F.sum(money("o_totalprice")).alias("s"))
    return (per_customer.join(t.customer.select("c_custkey", "c_mktsegment"),
                              F.col("o_custkey") == F.col("c_custkey"), "inner")
            .groupBy("o_orderpriority", "c_mktsegment")
            .agg(F.sum("n").alias("n_orders"), total("s").alias("total_price")))


@query("join_left_defaults", """
SELECT o_orderkey, o_custkey AS custkey, COALESCE(c_name, 'NA') AS customer_name,
  COALESCE(c_acctbal, 0) AS balance, o_totalprice AS price
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey""")
def join_left_defaults(t):
    building = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", "c_acctbal")
    renamed = (building.withColumnRenamed("c_custkey", "custkey").withColumnRenamed("c_acctbal", "balance")
               .withColumnRenamed("c_name", "customer_name"))
    orders = t.orders.withColumnRenamed("o_custkey", "custkey").withColumnRenamed("o_totalprice", "price")
    return (rel.left_join_defaults(orders, renamed, "custkey", {"customer_name": "NA", "balance": 0.0})
            .drop("o_orderdate", "o_orderstatus", "o_orderpriority"))


@query("join_two_roles", f"""
SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, {sql_total(SQL_REVENUE)} AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey
JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY ALL""")
def join_two_roles(t):
    # Reduced on the way: lines to (customer, supplier nation), then to nation pairs.
    sold = (t.lineitem.select("l_orderkey", "l_suppkey", revenue().alias("rev"))
            .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("o_custkey", "s_nationkey").agg(F.sum("rev").alias("rev")))
    homes = (sold.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
             .groupBy("c_nationkey", "s_nationkey").agg(F.sum("rev").alias("rev")))
    nation = t.nation.select("n_nationkey", "n_name")
    buyer, seller = nation.alias("buyer"), nation.alias("seller")
    return (homes.join(buyer, F.col("c_nationkey") == F.col("buyer.n_nationkey"))
            .join(seller, F.col("s_nationkey") == F.col("seller.n_nationkey"))
            .select(F.col("buyer.n_name").alias("customer_nation"),
                    F.col("seller.n_name").alias("supplier_nation"),
                    F.col("rev").cast("double").alias("revenue")))


@query("join_self_two_hop", f"""
WITH {derived.SQL_PLACES}
SELECT DISTINCT a.src, b.dst FROM edges a JOIN edges b ON a.dst = b.src AND a.src <> b.dst""")
def join_self_two_hop(t):
    return rel.two_hop(derived.place_graph(t).edges)


@query("join_broadcast", f"""
SELECT r_name, count(*) AS n_customers, {sql_total(sql_money('c_acctbal'))} AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def join_broadcast(t):
    located = rel.lookup(t.customer, t.nation, "c_nationkey", "n_nationkey", {"regionkey": "n_regionkey"}, "inner")
    named = rel.lookup(located, t.region, "regionkey", "r_regionkey", {"r_name": "r_name"}, "inner")
    return named.groupBy("r_name").agg(n_rows().alias("n_customers"), total(money("c_acctbal")).alias("balance"))


@query("join_left_group", """
SELECT c_custkey, c_name, count(o_orderkey) AS total_orders,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS finished_orders
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def join_left_group(t):
    return t.spark.sql("""
        SELECT c_custkey, c_name, COALESCE(n, 0) AS total_orders, COALESCE(f, 0) AS finished_orders
        FROM {customer} LEFT JOIN (
          SELECT o_custkey, COUNT(*) AS n, SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS f
          FROM {orders} GROUP BY o_custkey) ON c_custkey = o_custkey""", customer=t.customer, orders=t.orders)


@query("left_join_defaults", f"""
SELECT c_custkey, COALESCE(n, 0) AS n_orders, COALESCE(s, 0) AS total_price FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n, {sql_total(sql_money('o_totalprice'))} AS s FROM orders
  WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON c_custkey = o_custkey""")
def left_join_defaults(t):
    totals = (t.orders.where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(n_rows().alias("n_orders"), total(money("o_totalprice")).alias("total_price")))
    return rel.left_join_defaults(t.customer.select("c_custkey"), totals, "c_custkey",
                                  {"n_orders": 0, "total_price": 0.0})


@query("union_all_metrics", f"""
SELECT 'orders' AS source, o_orderstatus AS status, count(*) AS n_rows FROM orders GROUP BY ALL
UNION ALL SELECT 'lineitem', l_linestatus, count(*) FROM lineitem GROUP BY ALL""")
def union_all_metrics(t):
    def side(df, column, label):
        return df.groupBy(F.col(column).alias("status")).agg(n_rows().alias("n_rows")).withColumn(
            "source", F.lit(label))
    return rel.union_all(side(t.orders, "o_orderstatus", "orders"), side(t.lineitem, "l_linestatus", "lineitem"))


@query("union_distinct", "SELECT o_custkey AS key FROM orders UNION SELECT user_id FROM events")
def union_distinct(t):
    return rel.union_distinct(t.orders.select(F.col("o_custkey").alias("key")),
                              t.events.select(F.col("user_id").alias("key")))


@query("distinct_values", "SELECT DISTINCT event_type, user_id FROM events")
def distinct_values(t):
    return t.events.select("event_type", "user_id").distinct()


@query("dedup_keys", """
SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def dedup_keys(t):
    return rel.keep_first(t.events.select("user_id", "event_type", "event_id", "ts", "value"),
                          ["user_id", "event_type"], ["ts", "event_id"])


@query("find_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def find_duplicates(t):
    return rel.find_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("user_completion", f"""
SELECT * FROM (SELECT o_custkey, count(*) AS total_tasks, {sql_count("o_orderstatus = 'F'")} AS completed_tasks,
  CAST({sql_count("o_orderstatus = 'F'")} * 100.0 / count(*) AS DECIMAL(5,2)) AS completion_rate
FROM orders GROUP BY o_custkey) WHERE total_tasks > 1""")
def user_completion(t):
    return completion_rates(t.orders, ["o_custkey"], F.col("o_orderstatus") == "F").where("total_tasks > 1")


@query("discount_tier_default", """
SELECT CASE WHEN l_discount < 0.1 THEN 'Low' WHEN l_discount < 0.2 THEN 'Medium' ELSE 'High' END AS discount_tier,
  count(*) AS orders FROM lineitem GROUP BY 1""")
def discount_tier_default(t):
    return t.lineitem.groupBy(below(F.col("l_discount"), DISCOUNT_TIERS, "High").alias("discount_tier")).agg(
        n_rows().alias("orders"))
