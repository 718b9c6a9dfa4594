"""Aggregates, reports and window queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brightwell.functions.bands import DISTANCE_GROUPS, below, first_match
from brightwell.functions.numbers import mean, money, n_rows, round_half_up, total
from brightwell.operators import aggregate as agg
from brightwell.operators import ordered, rollups, skew
from brightwell.plans.registry import (
    SQL_REVENUE,
    query,
    sql_count,
    sql_mean,
    sql_money,
    sql_percent,
    sql_ratio,
    sql_round,
    sql_total,
)
from brightwell.plans.relational import revenue
from brightwell.session import checkpoint_folder, cut_lineage


_GLOBAL_SQL = f"""SELECT count(*) AS n_rows, {sql_total(sql_money('l_extendedprice'))} AS sum_l_extendedprice,
  {sql_mean(sql_money('l_extendedprice'))} AS avg_l_extendedprice, min(l_extendedprice) AS min_l_extendedprice,
  max(l_extendedprice) AS max_l_extendedprice"""


@query("agg_global", f"{_GLOBAL_SQL} FROM lineitem")
def agg_global(t):
    return agg.profile(t.lineitem, [], agg.basic_metrics("l_extendedprice"))


@query("agg_grouped", f"{_GLOBAL_SQL}, l_returnflag, l_linestatus FROM lineitem GROUP BY l_returnflag, l_linestatus")
def agg_grouped(t):
    return agg.profile(t.lineitem, ["l_returnflag", "l_linestatus"], agg.basic_metrics("l_extendedprice"))


@query("agg_select_expr", f"""
SELECT count(*) AS record_count, {sql_total(sql_money('l_quantity'))} AS total_quantity,
  {sql_round(sql_mean(sql_money('l_extendedprice')))} AS rounded_avg_price,
  count(DISTINCT l_orderkey) AS unique_orders FROM lineitem""")
def agg_select_expr(t):
    return t.lineitem.selectExpr(
        "count(1) AS record_count", "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity",
        "CAST(round(CAST(try_divide(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), "
        "count(l_extendedprice)) AS DECIMAL(24,6)), 2) AS DOUBLE) AS rounded_avg_price",
        "count(DISTINCT l_orderkey) AS unique_orders")


@query("agg_dict_form", """
SELECT count(*) AS n_rows, min(l_quantity) AS min_qty, max(l_shipdate) AS last_ship FROM lineitem""")
def agg_dict_form(t):
    found = t.lineitem.agg({"*": "count", "l_quantity": "min", "l_shipdate": "max"})
    return found.select(F.col("count(1)").alias("n_rows"), F.col("min(l_quantity)").alias("min_qty"),
                        F.col("max(l_shipdate)").alias("last_ship"))


@query("agg_revenue", f"""
SELECT l_returnflag, {sql_round(f'sum({SQL_REVENUE})')} AS revenue FROM lineitem GROUP BY l_returnflag""")
def agg_revenue(t):
    return t.lineitem.groupBy("l_returnflag").agg(round_half_up(F.sum(revenue())).alias("revenue"))


@query("agg_count_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts,
  count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY l_returnflag""")
def agg_count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("n_orders"), F.count_distinct("l_partkey").alias("n_parts"),
        F.count_distinct("l_suppkey").alias("n_suppliers"))


@query("agg_approx_distinct", """
SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n_events, TRUE AS estimate_is_close
FROM events GROUP BY event_type""")
def agg_approx_distinct(t):
    """The estimate lies within three standard errors of the exact count.

    The exact count is an aggregate of its own: beside it, the sketch would be
    kept for every pair of type and user."""
    rsd = 0.02
    estimates = t.events.groupBy("event_type").agg(
        F.approx_count_distinct("user_id", rsd).alias("estimate"), n_rows().alias("n_events"))
    exact = agg.distinct_per_key(t.events, "event_type", "user_id", "users")
    return agg.attach_by_key(estimates, exact, ["event_type"]).select(
        "event_type", "users", "n_events",
        (F.abs(F.col("estimate") - F.col("users")) <= 3 * rsd * F.col("users") + 1).alias("estimate_is_close"))


@query("agg_moments", f"""
SELECT event_type, {sql_round('stddev_samp(value)', 6)} AS std_dev, {sql_round('var_samp(value)', 6)} AS variance
FROM events GROUP BY event_type""")
def agg_moments(t):
    wanted = {k: v for k, v in agg.distribution("value").items() if k in ("std_dev", "variance")}
    return agg.profile(t.events, ["event_type"], wanted)


@query("agg_shape", f"""
WITH m AS (SELECT event_type AS et, avg(value) AS mu FROM events GROUP BY 1),
p AS (SELECT event_type, avg((value - mu) ** 2) AS m2, avg((value - mu) ** 3) AS m3, avg((value - mu) ** 4) AS m4
      FROM events JOIN m ON event_type = et GROUP BY event_type)
SELECT event_type, {sql_round('m3 / m2 ** 1.5', 6)} AS skewness, {sql_round('m4 / m2 ** 2 - 3', 6)} AS kurtosis FROM p""")
def agg_shape(t):
    wanted = {k: v for k, v in agg.distribution("value").items() if k in ("skewness", "kurtosis")}
    return agg.profile(t.events, ["event_type"], wanted)


@query("agg_percentiles", """
SELECT event_type, quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS median,
  quantile_disc(value, 0.75) AS p75, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99
FROM events GROUP BY event_type""")
def agg_percentiles(t):
    return agg.percentiles(t.events, ["event_type"], "value",
                           {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99})


@query("agg_conditional", f"""
SELECT o_orderpriority, count(*) AS n_orders,
  CAST(sum(CASE WHEN o_totalprice > 300000 THEN {sql_money('o_totalprice')} ELSE 0 END) AS DOUBLE) AS high_value,
  {sql_count('o_totalprice > 300000')} AS high_orders,
  {sql_mean("CASE WHEN o_totalprice > 300000 THEN " + sql_money('o_totalprice') + " END")} AS avg_high
FROM orders GROUP BY o_orderpriority""")
def agg_conditional(t):
    high, price = F.col("o_totalprice") > 300000, money("o_totalprice")
    return t.orders.groupBy("o_orderpriority").agg(
        n_rows().alias("n_orders"), F.sum(F.when(high, price).otherwise(0)).cast("double").alias("high_value"),
        F.count_if(high).alias("high_orders"), mean(F.when(high, price)).alias("avg_high"))


@query("agg_rates", f"""
SELECT o_orderpriority, count(*) AS total_tasks, {sql_count("o_orderstatus = 'F'")} AS completed_tasks,
  CAST({sql_count("o_orderstatus = 'F'")} * 100.0 / count(*) AS DECIMAL(5,2)) AS completion_rate
FROM orders GROUP BY o_orderpriority""")
def agg_rates(t):
    return agg.completion_rates(t.orders, ["o_orderpriority"], F.col("o_orderstatus") == "F")


@query("agg_collect", """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types,
  count(DISTINCT event_type) AS n_values FROM events GROUP BY user_id""")
def agg_collect(t):
    return agg.value_list(t.events, ["user_id"], "event_type", "event_types")


@query("agg_first_last", """
SELECT user_id, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value
FROM events GROUP BY user_id""")
def agg_first_last(t):
    return agg.first_and_last(t.events, ["user_id"], "value", ["ts", "event_id"])


@query("agg_argmax", """
SELECT event_type, value, event_id, user_id FROM (SELECT *, row_number() OVER (
  PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def agg_argmax(t):
    return agg.row_with_largest(t.events, ["event_type"], "value", ["event_id", "user_id"], "event_id")


def _rollup_sql(kind: str) -> str:
    return f"""
SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'ALL_STATUSES' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN grouping(o_orderpriority) = 1 THEN 'ALL_PRIORITIES' ELSE o_orderpriority END AS o_orderpriority,
  CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS n_orders,
  {sql_mean(sql_money('o_totalprice'))} AS avg_price
FROM orders GROUP BY {kind}(o_orderstatus, o_orderpriority)"""


def _rollup(t, cube):
    return agg.rollup_report(
        t.orders, ["o_orderstatus", "o_orderpriority"],
        {"n_orders": n_rows(), "avg_price": mean(money("o_totalprice"))},
        {"o_orderstatus": "ALL_STATUSES", "o_orderpriority": "ALL_PRIORITIES"}, cube)


@query("agg_rollup", _rollup_sql("ROLLUP"))
def agg_rollup(t):
    return agg.subtotals_last(_rollup(t, False), ["o_orderstatus", "o_orderpriority"])


@query("agg_cube", _rollup_sql("CUBE"))
def agg_cube(t):
    return _rollup(t, True)


@query("rollup_price_band", f"""
SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS l_returnflag,
  CASE WHEN grouping(band) = 1 THEN 'ALL' ELSE band END AS price_band,
  count(*) AS item_count, {sql_total(sql_money('l_quantity'))} AS total_quantity, {sql_total(SQL_REVENUE)} AS revenue
FROM (SELECT *, CASE WHEN l_extendedprice > 50000 THEN 'Premium' WHEN l_extendedprice > 20000 THEN 'Standard'
      ELSE 'Budget' END AS band FROM lineitem) GROUP BY ROLLUP (l_returnflag, band)""")
def rollup_price_band(t):
    price = F.col("l_extendedprice")
    banded = t.lineitem.withColumn("price_band", first_match(
        [(price > 50000, "Premium"), (price > 20000, "Standard")], "Budget"))
    return agg.rollup_report(
        banded, ["l_returnflag", "price_band"],
        {"item_count": n_rows(), "total_quantity": total(money("l_quantity")), "revenue": total(revenue())},
        {"l_returnflag": "ALL", "price_band": "ALL"}).drop("level")


@query("agg_having", """
SELECT l_suppkey, l_returnflag, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) >= 200""")
def agg_having(t):
    return t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(n_rows().alias("n_rows")).where("n_rows >= 200")


@query("agg_union_hub", f"""
SELECT hub, CAST(sum(dep) AS BIGINT) AS total_departures, CAST(sum(arr) AS BIGINT) AS total_arrivals,
  CAST(sum(dep + arr) AS BIGINT) AS total_operations, CAST(sum(d) AS DOUBLE) / sum(k) AS weighted_avg
FROM (SELECT c_nationkey AS hub, count(*) AS dep, 0 AS arr, sum({sql_money('c_acctbal')}) AS d, count(c_acctbal) AS k
      FROM customer GROUP BY 1
      UNION ALL SELECT s_nationkey, 0, count(*), sum({sql_money('s_acctbal')}), count(s_acctbal) FROM supplier GROUP BY 1)
GROUP BY hub""")
def agg_union_hub(t):
    return agg.hub_activity(
        t.customer.select(F.col("c_nationkey").alias("hub"), F.col("c_acctbal").alias("balance")),
        t.supplier.select(F.col("s_nationkey").alias("hub"), F.col("s_acctbal").alias("balance")),
        "hub", "balance")


@query("weekly_summary", f"""
SELECT o_orderpriority, CAST(week(o_orderdate) AS INT) AS week_number, count(DISTINCT o_orderkey) AS num_invoices,
  {sql_total(sql_money('l_quantity'))} AS total_quantity, {sql_total(SQL_REVENUE)} AS invoice_value
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE year(o_orderdate) = 1997 GROUP BY ALL""")
def weekly_summary(t):
    # The orders of one year go first: most lines find no partner and are gone.
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return agg.weekly_summary(lines, "o_orderpriority", F.col("o_orderdate"), 1997, "o_orderkey",
                              money("l_quantity"), revenue())


def _sales(t):
    return t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))


@query("customer_value", f"""
SELECT o_custkey, count(DISTINCT o_orderkey) AS order_count, {sql_total(sql_money('l_quantity'))} AS total_items,
  {sql_total(SQL_REVENUE)} AS customer_value, {sql_mean(sql_money('l_extendedprice'))} AS avg_item_price,
  count(DISTINCT l_partkey) AS product_variety,
  {sql_round(sql_ratio(f'sum({SQL_REVENUE})', 'count(DISTINCT o_orderkey)'))} AS avg_order_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def customer_value(t):
    return agg.customer_value(_sales(t), "o_custkey", "o_orderkey", revenue(), "l_quantity", "l_partkey",
                              "l_extendedprice", agg.tasks_for(t.lineitem))


@query("market_summary", f"""
WITH s AS (SELECT c_mktsegment, count(DISTINCT c_custkey) AS active_customers, count(DISTINCT o_orderkey) AS total_orders,
  {sql_total(SQL_REVENUE)} AS market_revenue, {sql_mean(SQL_REVENUE)} AS avg_transaction_value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)
SELECT *, {sql_round(sql_ratio('total_orders', 'active_customers'))} AS orders_per_customer,
  {sql_round(sql_ratio('market_revenue', 'active_customers'))} AS revenue_per_customer FROM s""")
def market_summary(t):
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(revenue()).alias("rev"), F.count(revenue()).alias("lines"))
    orders = (t.orders.select("o_orderkey", "o_custkey")
              .join(per_order, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")))
    return agg.market_summary(orders, "c_mktsegment", "c_custkey", "rev", "lines")


@query("product_matrix", f"""
WITH s AS (SELECT p_partkey, min(p_name) AS product_name, {sql_total(sql_money('l_quantity'))} AS total_quantity,
  count(DISTINCT o_orderkey) AS order_frequency, count(DISTINCT o_custkey) AS customer_reach,
  {sql_total(SQL_REVENUE)} AS total_revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY p_partkey)
SELECT *, {sql_round(sql_ratio('total_revenue', 'total_quantity'))} AS revenue_per_unit,
  {sql_round(sql_ratio('total_quantity', 'order_frequency'))} AS avg_quantity_per_order FROM s""")
def product_matrix(t):
    lines = _sales(t).withColumnRenamed("l_partkey", "p_partkey")
    return agg.product_matrix(lines, t.part, "p_partkey", "p_name", "o_orderkey", "o_custkey", revenue(), "l_quantity",
                              agg.tasks_for(t.lineitem))


@query("category_performance", f"""
SELECT p_type, count(*) AS total_orders, {sql_mean(SQL_REVENUE)} AS avg_order_value,
  CAST(max({SQL_REVENUE}) AS DOUBLE) AS max_order, CAST(min({SQL_REVENUE}) AS DOUBLE) AS min_order,
  {sql_mean(sql_money('l_quantity'))} AS avg_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def category_performance(t):
    lines = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return agg.category_performance(lines, "p_type", revenue(), "l_quantity")


@query("regional_performance", f"""
SELECT r_name, count(*) AS orders, {sql_mean(sql_money('o_totalprice'))} AS avg_amount,
  {sql_total(sql_money('o_totalprice'))} AS total_revenue
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def regional_performance(t):
    homes = (t.customer.select("c_custkey", "c_nationkey")
             .join(t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
             .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name"))
    placed = t.orders.join(homes, F.col("o_custkey") == F.col("c_custkey"))
    return agg.regional_performance(placed, "r_name", money("o_totalprice"))


@query("product_performance", f"""
SELECT l_partkey, count(*) AS units_sold, {sql_mean(sql_money('l_extendedprice'))} AS avg_price,
  {sql_mean(sql_money('l_discount'))} AS avg_discount, {sql_total(SQL_REVENUE)} AS revenue
FROM lineitem GROUP BY l_partkey""")
def product_performance(t):
    return agg.product_performance(t.lineitem, "l_partkey", "l_extendedprice", "l_discount", revenue())


@query("frequent_customers", f"""
SELECT o_custkey, count(*) AS order_count, {sql_mean(sql_money('o_totalprice'))} AS avg_spend
FROM orders GROUP BY o_custkey HAVING count(*) >= 3""")
def frequent_customers(t):
    return agg.frequent_customers(t.orders, "o_custkey", money("o_totalprice"))


@query("carrier_performance", f"""
SELECT l_suppkey, count(*) AS total_flights, {sql_count("l_returnflag = 'R'")} AS cancelled_flights,
  {sql_percent(sql_count("l_returnflag = 'R'"), 'count(*)', 2)} AS cancellation_rate,
  {sql_mean(sql_money('l_quantity'))} AS avg_distance, max(l_quantity) AS max_distance
FROM lineitem GROUP BY l_suppkey""")
def carrier_performance(t):
    return agg.carrier_performance(t.lineitem, "l_suppkey", F.col("l_returnflag") == "R", "l_quantity")


@query("route_performance", f"""
SELECT l_suppkey, l_partkey, count(*) AS flight_count, count(DISTINCT l_linestatus) AS carriers_serving,
  {sql_mean(sql_money('l_quantity'))} AS avg_distance, {sql_count("l_returnflag = 'R'")} AS cancelled_count
FROM lineitem GROUP BY ALL HAVING count(*) >= 3""")
def route_performance(t):
    return agg.route_performance(t.lineitem, "l_suppkey", "l_partkey", "l_linestatus",
                                 F.col("l_returnflag") == "R", "l_quantity", 3, agg.tasks_for(t.lineitem))


@query("haul_mix", f"""
SELECT l_suppkey, count(*) AS total_flights, {sql_count('l_quantity < 15')} AS short_haul,
  {sql_count('l_quantity BETWEEN 15 AND 35')} AS medium_haul, {sql_count('l_quantity > 35')} AS long_haul,
  {sql_round(sql_mean("CASE WHEN l_returnflag <> 'R' THEN " + sql_money('l_quantity') + " END"), 0)} AS avg_distance_completed
FROM lineitem GROUP BY l_suppkey""")
def haul_mix(t):
    return agg.haul_mix(t.lineitem, "l_suppkey", F.col("l_returnflag") == "R", "l_quantity", 15, 35)


@query("route_summary", f"""
SELECT l_suppkey, CASE WHEN l_extendedprice < 500 THEN 'Short' WHEN l_extendedprice < 1000 THEN 'Medium' ELSE 'Long'
  END AS distance_category, count(*) AS flight_count, {sql_count("l_returnflag <> 'R'")} AS completed_flights
FROM lineitem GROUP BY ALL""")
def route_summary(t):
    category = below(F.col("l_extendedprice"), DISTANCE_GROUPS, "Long").alias("distance_category")
    return t.lineitem.groupBy("l_suppkey", category).agg(
        n_rows().alias("flight_count"), F.count_if(F.col("l_returnflag") != "R").alias("completed_flights"))


@query("performance_levels", f"""
SELECT c_mktsegment, CASE WHEN c_acctbal > 9000 THEN 'Excellent' WHEN c_acctbal > 8000 THEN 'Good' ELSE 'Average' END
  AS performance_level, count(*) AS n_rows, {sql_mean(sql_money('c_acctbal'))} AS avg_balance
FROM customer WHERE c_acctbal > 250 GROUP BY ALL HAVING count(*) > 1""")
def performance_levels(t):
    balance = F.col("c_acctbal")
    level = first_match([(balance > 9000, "Excellent"), (balance > 8000, "Good")], "Average")
    return (t.customer.where(balance > 250).groupBy("c_mktsegment", level.alias("performance_level"))
            .agg(n_rows().alias("n_rows"), mean(money("c_acctbal")).alias("avg_balance")).where("n_rows > 1"))


@query("cached_multi_agg", f"""
SELECT 'all' AS part, count(*) AS n_rows, {sql_total(SQL_REVENUE)} AS revenue FROM lineitem WHERE l_quantity > 25
UNION ALL SELECT l_returnflag, count(*), {sql_total(SQL_REVENUE)} FROM lineitem WHERE l_quantity > 25 GROUP BY l_returnflag
UNION ALL SELECT l_linestatus, count(*), {sql_total(SQL_REVENUE)} FROM lineitem WHERE l_quantity > 25 GROUP BY l_linestatus""")
def cached_multi_agg(t):
    # The coarser totals are taken from the finest grouping, which is kept, so the
    # lines are read and aggregated once. Its files go when nothing refers to them.
    held = cut_lineage(t.lineitem.where("l_quantity > 25").groupBy("l_returnflag", "l_linestatus")
              .agg(n_rows().alias("n"), F.sum(revenue()).alias("r")))

    def by(df, part):
        return df.groupBy(part.alias("part")).agg(F.sum("n").alias("n_rows"), total("r").alias("revenue"))
    return (by(held, F.lit("all")).unionByName(by(held, F.col("l_returnflag")))
            .unionByName(by(held, F.col("l_linestatus"))))


# Window queries -----------------------------------------------------------

_ORDER = ["o_orderdate", "o_orderkey"]
_ORDERS = ("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
_OVER = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"


@query("win_row_number", f"SELECT o_custkey, o_orderkey, row_number() {_OVER}) AS row_number FROM orders")
def win_row_number(t):
    return ordered.row_numbers(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), _ORDER,
                               ["o_custkey"]).drop("o_orderdate")


@query("win_lag_lead", f"""
SELECT o_custkey, o_orderkey, lag(o_totalprice) {_OVER}) AS previous, lead(o_totalprice) {_OVER}) AS following
FROM orders""")
def win_lag_lead(t):
    return ordered.neighbours(t.orders.select(*_ORDERS), "o_totalprice", _ORDER, ["o_custkey"]).select(
        "o_custkey", "o_orderkey", "previous", "following")


@query("win_running_total", f"""
SELECT o_custkey, o_orderkey, CAST(sum({sql_money('o_totalprice')}) {_OVER}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM orders""")
def win_running_total(t):
    priced = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", money("o_totalprice").alias("price"))
    return ordered.running_sum(priced, "price", _ORDER, ["o_custkey"]).select(
        "o_custkey", "o_orderkey", F.col("running_total").cast("double").alias("running_total"))


@query("win_moving_sum", f"""
SELECT o_custkey, o_orderkey, CAST(sum({sql_money('o_totalprice')}) {_OVER}
  ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS DOUBLE) AS moving_sum FROM orders""")
def win_moving_sum(t):
    priced = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", money("o_totalprice").alias("price"))
    return ordered.moving_sum_of_two(priced, "price", _ORDER, ["o_custkey"]).select(
        "o_custkey", "o_orderkey", F.col("moving_sum").cast("double").alias("moving_sum"))


@query("win_share", f"""
SELECT o_custkey, o_orderkey, CAST(sum({sql_money('o_totalprice')}) OVER (PARTITION BY o_custkey) AS DOUBLE) AS group_total,
  {sql_percent('o_totalprice', f"sum({sql_money('o_totalprice')}) OVER (PARTITION BY o_custkey)", 2)} AS share_pct
FROM orders""")
def win_share(t):
    priced = t.orders.select("o_custkey", "o_orderkey", money("o_totalprice").alias("price"))
    return ordered.share_of_group(priced, "price", ["o_custkey"]).select(
        "o_custkey", "o_orderkey", F.col("group_total").cast("double").alias("group_total"), "share_pct")


@query("win_rank_agg", """
SELECT l_returnflag, l_suppkey, count(*) AS n_rows,
  rank() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC) AS rank_in_flag,
  dense_rank() OVER (ORDER BY count(*) DESC) AS overall_rank
FROM lineitem GROUP BY l_returnflag, l_suppkey HAVING count(*) >= 3""")
def win_rank_agg(t):
    # Read four times below, so the small aggregate is kept.
    counts = cut_lineage(t.lineitem.groupBy("l_returnflag", "l_suppkey").agg(n_rows().alias("n_rows")).where("n_rows >= 3"))
    in_flag = ordered.ranks(counts, "n_rows", ["l_returnflag"], rank="rank_in_flag", dense_rank="__d").drop("__d")
    return ordered.ranks(in_flag, "n_rows", rank="__r", dense_rank="overall_rank").drop("__r")


@query("win_dense_rank", """
SELECT o_orderkey, o_orderpriority, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC) AS date_rank,
  rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC) AS date_position FROM orders""")
def win_dense_rank(t):
    return ordered.ranks(t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate"), "o_orderdate",
                         ["o_orderpriority"], rank="date_position", dense_rank="date_rank").drop("o_orderdate")


@query("global_row_number", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_number FROM orders""")
def global_row_number(t):
    return ordered.row_numbers(t.orders.select("o_orderkey", "o_totalprice"),
                               [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("global_running_total", f"""
SELECT o_orderkey, CAST(sum({sql_money('o_totalprice')}) OVER (ORDER BY o_orderdate, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM orders""")
def global_running_total(t):
    priced = t.orders.select("o_orderkey", "o_orderdate", money("o_totalprice").alias("price"))
    return ordered.running_sum(priced, "price", _ORDER).select(
        "o_orderkey", F.col("running_total").cast("double").alias("running_total"))


# Announced topics: sessions, sequences, salting ----------------------------

@query("session_windows", """
WITH s AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 6 HOURS THEN 1 ELSE 0 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_number FROM s)
SELECT user_id, session_number, min(ts) AS session_start, max(ts) + INTERVAL 6 HOURS AS session_end,
  count(*) AS n_events FROM n GROUP BY user_id, session_number""")
def session_windows(t):
    numbered = ordered.sessions(t.events.select("user_id", "event_id", "ts"), "user_id", "ts", "6 HOURS", "event_id")
    return numbered.groupBy("user_id", "session_number").agg(
        F.min("ts").alias("session_start"), (F.max("ts") + F.expr("INTERVAL 6 HOURS")).alias("session_end"),
        n_rows().alias("n_events"))


@query("sequence_match", """
SELECT user_id, event_id, ts, next_ts FROM (SELECT *, lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'click' AND next_type = 'purchase' AND next_ts <= ts + INTERVAL 1 HOUR""")
def sequence_match(t):
    return ordered.followed_by(t.events.select("user_id", "event_id", "ts", "event_type"), "user_id", "ts",
                               "event_type", "click", "purchase", "1 HOUR", "event_id").select(
        "user_id", "event_id", "ts", "next_ts")


@query("salted_agg", f"""
SELECT l_returnflag, count(*) AS n_rows, {sql_total(SQL_REVENUE)} AS revenue, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY l_returnflag""")
def salted_agg(t):
    return skew.salted_aggregate(
        t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"),
        ["l_returnflag"], {"n": n_rows(), "r": F.sum(revenue()), "m": F.max("l_extendedprice")},
        {"n_rows": F.sum("n"), "revenue": total("r"), "max_price": F.max("m")})


@query("salted_join", f"""
SELECT s_nationkey, count(*) AS n_rows, {sql_total(sql_money('l_quantity'))} AS sum_qty
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey""")
def salted_join(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("suppkey"), "l_quantity")
    joined = skew.salted_join(lines, t.supplier.select(F.col("s_suppkey").alias("suppkey"), "s_nationkey"), "suppkey")
    return joined.groupBy("s_nationkey").agg(n_rows().alias("n_rows"), total(money("l_quantity")).alias("sum_qty"))


def _stored_rollup(t, keys, metrics):
    return rollups.Rollup(t.spark, f"{checkpoint_folder(t.spark)}/rollup-{uuid.uuid4().hex}", keys, metrics)


@query("sketch_rollup", """
WITH e AS (SELECT event_type, date_trunc('month', ts) AS month, user_id FROM events)
SELECT event_type, CAST(month AS DATE) AS month, count(*) AS n_events, count(DISTINCT user_id) AS users, TRUE AS users_are_close,
  TRUE AS median_is_close FROM e GROUP BY GROUPING SETS ((event_type, month), (event_type), ())""")
def sketch_rollup(t):
    """Daily sketches, stored and merged to months, types and all. Estimates of users lie
    within three standard errors, medians within three per cent of the ranks."""
    daily = _stored_rollup(t, ["event_type", "day"], {
        "n_events": rollups.Metric("count"), "estimate": rollups.Metric("approx_distinct", "user_id"),
        "median": rollups.Metric("approx_quantile", "value")})
    daily.apply(1, t.events.withColumn("day", F.to_date("ts")))
    month = F.trunc("day", "month")
    exact = t.events.withColumn("month", F.trunc(F.to_date("ts"), "month"))
    made = []
    for keys in (["event_type", "month"], ["event_type"], []):
        merged = daily.read(keys, {"month": month} if "month" in keys else None)
        # One row for each group of the report; beside it each event is held once.
        sides = exact.select(*keys, "user_id", "value").withColumn("__all", F.lit(0)).join(
            merged.select(*keys, "median").withColumn("__all", F.lit(0)), [*keys, "__all"])
        known = sides.groupBy(*keys, "__all").agg(
            F.count_distinct("user_id").alias("users"), F.count("value").alias("n_values"),
            F.count_if(F.col("value") < F.col("median")).alias("below"), F.count_if(F.col("value") <= F.col("median")).alias("upto"))
        both = merged.withColumn("__all", F.lit(0)).join(known, [*keys, "__all"])
        rank = F.col("n_values") * F.lit(0.5)
        made.append(both.select(
            *[F.col(k) if k in keys else F.lit(None).cast(kind).alias(k) for k, kind in (("event_type", "string"), ("month", "date"))],
            "n_events", "users", (F.abs(F.col("estimate") - F.col("users")) <= 3 * rollups.DISTINCT_ERROR * F.col("users") + 1).alias("users_are_close"),
            ((F.col("below") - 0.03 * F.col("n_values") - 1 <= rank) & (F.col("upto") + 0.03 * F.col("n_values") + 1 >= rank)).alias("median_is_close")))
    return made[0].union(made[1]).union(made[2])


@query("incremental_metrics", f"""
SELECT event_type, count(*) AS n_events, {sql_total('CAST(value AS DECIMAL(18,2))')} AS total_value,
  min(CAST(value AS DECIMAL(18,2)))::DOUBLE AS least, max(CAST(value AS DECIMAL(18,2)))::DOUBLE AS most,
  count(DISTINCT user_id) AS users, max(ts) AS last_ts FROM events GROUP BY event_type""")
def incremental_metrics(t):
    """Events in four increments. Some come with a wrong value and user first, which a later
    increment takes back; one increment is sent again, and states are compacted between."""
    kept = _stored_rollup(t, ["event_type"], {
        "n_events": rollups.Metric("count"), "total_value": rollups.Metric("sum", "amount"), "least": rollups.Metric("min", "amount"),
        "most": rollups.Metric("max", "amount"), "users": rollups.Metric("distinct", "user_id"), "last_ts": rollups.Metric("max", "ts")})
    events = t.events.select("event_type", "event_id", "user_id", "ts", money("value").alias("amount"))
    odd = F.col("event_id") % 10 == 0
    wrong = events.withColumns({"amount": F.when(odd, F.col("amount") + 1000).otherwise(F.col("amount")),
                                "user_id": F.when(odd, -F.col("event_id")).otherwise(F.col("user_id"))})
    part = F.col("event_id") % 3
    for number in (1, 2):
        kept.apply(number, wrong.where(part == number - 1))
    kept.compact()
    kept.apply(3, wrong.where(part == 2))
    kept.apply(4, events.where(odd), retracted=wrong.where(odd))
    kept.apply(2, wrong.where(part == 1))
    return kept.read().withColumns({name: F.col(name).cast("double") for name in ("total_value", "least", "most")})
