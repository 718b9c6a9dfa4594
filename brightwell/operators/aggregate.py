"""Grouped reports: the aggregate shapes, each one shuffle after map-side partials."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwell.functions.numbers import mean, money, percent, ratio, round_half_up, total
from brightwell.operators.skew import with_salt
from brightwell.session import cut_lineage


def profile(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """``GROUP BY keys`` with named metrics; no keys gives one row."""
    columns = [expr.alias(name) for name, expr in metrics.items()]
    return df.groupBy(*keys).agg(*columns) if keys else df.agg(*columns)


def basic_metrics(value: str) -> dict[str, Column]:
    amount = money(value)
    return {
        "n_rows": F.count(F.lit(1)),
        f"sum_{value}": total(amount),
        f"avg_{value}": mean(amount),
        f"min_{value}": F.min(value),
        f"max_{value}": F.max(value),
    }


def distinct_count(df: DataFrame, column: str, rsd: float = 0.02) -> Column:
    """Exact on a table; on a stream, where Spark has no exact distinct count,
    a HyperLogLog estimate with bounded state and the given relative error. So
    the ``unique_`` columns of a report may differ between table and stream."""
    if df.isStreaming:
        return F.approx_count_distinct(column, rsd)
    return F.count_distinct(column)


SKETCH_BITS = 12


def sketched_count(column: str, rsd: float = 0.05) -> Column:
    """Distinct count by a HyperLogLog sketch, on tables and streams alike.

    The sketch holds few values as a list of 26-bit hashes, so small groups are counted
    right, where a register sketch loses values that meet in a register. It has 2 to the
    power of ``SKETCH_BITS`` registers (a standard error of 1.6 %) or as many more as
    ``rsd`` asks for: of very many groups none should then be three times ``rsd`` off.
    """
    bits = min(21, max(SKETCH_BITS, math.ceil(2 * math.log2(1.04 / rsd))))
    # Hashed first: the sketch would leave out empty texts.
    value = F.when(F.col(column).isNotNull(), F.xxhash64(column))
    return F.hll_sketch_estimate(F.hll_sketch_agg(value, bits))


MASK_BITS = 63


def value_masks(column: str, values: Sequence) -> list[Column]:
    """Aggregates: one bit per listed value that occurs, 63 values to a mask.

    Longs are all the state, where a set per group would leave hash aggregation
    and an exact distinct count would copy every row. A value that is not listed
    raises an error, so a count is never too small.
    """
    masks = []
    for at in range(0, len(values), MASK_BITS):
        part = F.array(*[F.lit(v) for v in values[at:at + MASK_BITS]])
        place = F.array_position(part, F.col(column))
        bits = F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int"))
        if at:
            masks.append(F.bit_or(F.when(place > 0, bits)))
            continue
        unknown = F.raise_error(F.concat(F.lit(f"{column} has a value that is not listed: "), F.col(column).cast("string")))
        known = F.array_contains(F.array(*[F.lit(v) for v in values]), F.col(column))
        masks.append(F.bit_or(F.when(place > 0, bits).when(~known, unknown.cast("long"))))
    return masks


def masked_count(masks: Sequence[Column]) -> Column:
    """How many values the masks stand for."""
    total = F.lit(0)
    for mask in masks:
        total = total + F.coalesce(F.bit_count(mask), F.lit(0))
    return total.cast("long")


def masked_values(masks: Sequence[Column], values: Sequence) -> Column:
    """The values the masks stand for, in the order given."""
    flags = [F.when(F.getbit(masks[i // MASK_BITS], F.lit(i % MASK_BITS)) == 1, F.lit(v)) for i, v in enumerate(values)]
    return F.array_compact(F.array(*flags))


def few_distinct(df: DataFrame, column: str, values: Sequence | None = None) -> Column:
    """Distinct count of a column; by bit masks where its values are known."""
    return masked_count(value_masks(column, values)) if values else distinct_count(df, column)


def distribution(value: str, digits: int = 6) -> dict[str, Column]:
    """Sample spread and population shape of one column."""
    number = F.col(value).cast("double")
    return {
        "std_dev": round_half_up(F.stddev_samp(number), digits),
        "variance": round_half_up(F.var_samp(number), digits),
        "skewness": round_half_up(F.skewness(number), digits),
        "kurtosis": round_half_up(F.kurtosis(number), digits),
    }


def approx_percentiles(value: str, points: Mapping[str, float], accuracy: int = 10_000) -> dict[str, Column]:
    """Estimated percentiles by a mergeable sketch, for streams and quick looks.

    Memory stays bounded for any group; the rank error is at most ``rows /
    accuracy``. All points are read from one sketch.
    """
    sketch = F.percentile_approx(value, list(points.values()), accuracy)
    return {name: sketch[i] for i, name in enumerate(points)}


POINT_SCALE = 1_000_000
RANGES_PER_OCTAVE = 16


def percentiles(df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """Exact percentiles of each key: the smallest value that at least the given
    share of the non-null values does not exceed. One row per key; NULL where a
    key has no value.

    Equal values are counted first. Values fall into ranges on a logarithmic
    scale; the counts of a key's ranges tell in which range each point lies, and
    only the values of these ranges are put in order. No task sorts a whole key.
    The counts are checkpointed, so the rows are read once.
    """
    number = F.col(value).cast("double")
    scale = F.signum(number) * F.floor(F.log2(F.abs(number) + 1) * RANGES_PER_OCTAVE)
    counts = cut_lineage(df.select(*keys, value).withColumn("__range", scale).groupBy(*keys, "__range", value)
                         .agg(F.count(value).alias("__n")))
    per_range = counts.groupBy(*keys, "__range").agg(F.sum("__n").alias("__n"))
    line = Window.partitionBy(*keys).orderBy("__range")
    ranges = per_range.withColumns({
        "__before": F.coalesce(F.sum("__n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "__all": F.sum("__n").over(Window.partitionBy(*keys))})
    wanted = {}
    for name, point in points.items():
        # The rank, rounded up in whole numbers; inside its range it is counted from there.
        share = F.lit(round(point * POINT_SCALE))
        rank = F.greatest(F.floor((F.col("__all") * share + (POINT_SCALE - 1)) / POINT_SCALE), F.lit(1)) - F.col("__before")
        wanted[f"__rank_{name}"] = F.when((rank > 0) & (rank <= F.col("__n")), rank)
    hit = F.lit(False)
    for name in wanted:
        hit = hit | F.col(name).isNotNull()
    targets = ranges.withColumns(wanted).where(hit).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__range").alias("__target"), *wanted)
    same = [F.col("__range") == F.col("__target")] + [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    inside = Window.partitionBy(*keys, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (counts.join(targets, same).withColumn("__upto", F.sum("__n").over(inside)).groupBy(*keys).agg(*[
        F.min(F.when(F.col("__upto") >= F.col(f"__rank_{name}"), F.col(value))).alias(name) for name in points]))
    every = per_range.select(*keys).distinct() if keys else None
    return attach_by_key(every, found, keys) if keys else found


def attach_by_key(df: DataFrame, by_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two aggregates with one row per key, NULL keys included."""
    match = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    added = [F.col(f"b.{c}") for c in by_key.columns if c not in keys]
    return df.alias("a").join(by_key.alias("b"), match, "left").select("a.*", *added)


def rollup_report(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column],
                  totals: Mapping[str, str], cube: bool = False) -> DataFrame:
    """Subtotals by ROLLUP (or CUBE). Subtotal rows are told apart by
    ``grouping``, so a real NULL in a key is never shown as a total."""
    grouped = df.cube(*keys) if cube else df.rollup(*keys)
    columns = [expr.alias(name) for name, expr in metrics.items()]
    marks = [F.grouping(key).alias(f"__is_total_{key}") for key in keys]
    result = grouped.agg(F.grouping_id().alias("level"), *marks, *columns)
    labelled = [
        F.when(F.col(f"__is_total_{key}") == 1, totals[key])
        .otherwise(F.col(key).cast("string")).alias(key) for key in keys]
    return result.select(*labelled, "level", *metrics)


def subtotals_last(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order a roll-up report so that every subtotal follows its detail rows."""
    bits = len(keys)
    order = []
    for position, key in enumerate(keys):
        bit = F.shiftright("level", bits - 1 - position).bitwiseAND(F.lit(1))
        order += [bit.asc(), F.col(key).asc_nulls_last()]
    return df.orderBy(*order)


def first_and_last(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """First and last value by an explicit order, the same on every run."""
    position = F.struct(*order)
    return df.groupBy(*keys).agg(
        F.min_by(value, position).alias(f"first_{value}"),
        F.max_by(value, position).alias(f"last_{value}"))


def row_with_largest(df: DataFrame, keys: Sequence[str], measure: str, columns: Sequence[str],
                     tie_break: str) -> DataFrame:
    """Columns of the row with the largest measure; ties go to the smallest tie-break."""
    best = F.max_by(F.struct(measure, *columns), F.struct(F.col(measure), -F.col(tie_break)))
    return (df.groupBy(*keys).agg(best.alias("__best"))
            .select(*keys, f"__best.{measure}", *[f"__best.{c}" for c in columns]))


def value_list(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted distinct values as one text, which is as long as a key has values.

    Duplicates are removed before the shuffle, so the array holds each value once.
    """
    slim = df.select(*keys, value).distinct()
    return slim.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(value)), ",").alias(name),
        F.count(F.lit(1)).alias("n_values"))


def completion_rates(df: DataFrame, keys: Sequence[str], done: Column) -> DataFrame:
    """Tasks, finished tasks and the rate as DECIMAL(5,2)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count_if(done).alias("completed_tasks"),
    ).withColumn(
        "completion_rate",
        (F.try_divide(F.col("completed_tasks").cast("decimal(20,4)") * 100, F.col("total_tasks"))
         ).cast("decimal(5,2)"))


def hub_activity(out_side: DataFrame, in_side: DataFrame, hub: str, distance: str) -> DataFrame:
    """Departures and arrivals per hub from two sides.

    Each side is aggregated on its own, then the small results are added. The
    mean keeps sum and count to the end, so it is weighted by rows.
    """
    def side(df, departures, arrivals):
        return df.groupBy(hub).agg(
            F.count(F.lit(1)).alias("n"), F.sum(money(distance)).alias("d"), F.count(distance).alias("k"),
        ).select(hub, (F.col("n") * departures).alias("dep"), (F.col("n") * arrivals).alias("arr"), "d", "k")

    return (side(out_side, 1, 0).unionByName(side(in_side, 0, 1)).groupBy(hub).agg(
        F.sum("dep").alias("total_departures"), F.sum("arr").alias("total_arrivals"),
        F.sum(F.col("dep") + F.col("arr")).alias("total_operations"),
        F.try_divide(F.sum("d").cast("double"), F.sum("k")).alias("weighted_avg")))


#: Parts of a route that holds many rows.
ROUTE_SALTS = 16
#: Rows aimed at in a task that keeps a group for nearly every row.
TASK_ROWS = 500_000


def tasks_for(df: DataFrame) -> int:
    """Tasks of about ``TASK_ROWS`` rows, as many as there are cores at least. The
    count of a stored table comes from its footers."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def dealt(df: DataFrame, keys: Sequence[str], tasks: int | None) -> DataFrame:
    """Rows dealt by keys before they are grouped by them.

    For groups of a few rows each, where partial results on the map side save nothing
    and one task's groups would grow with the file that it reads. With ``tasks`` of
    ``tasks_for``, a task's groups stay bounded at any size of the table.
    """
    return df if tasks is None else df.repartition(tasks, *keys)


def distinct_per_key(df: DataFrame, key: str, value: str, name: str, tasks: int | None = None) -> DataFrame:
    """Distinct values of each key, as an aggregate of its own: beside other
    aggregates, two distinct counts would copy every row. With ``tasks`` pairs are dealt."""
    return dealt(df.select(key, value), [key, value], tasks).distinct().groupBy(key).agg(F.count(value).alias(name))


def customer_value(lines: DataFrame, customer: str, order: str, value: Column, quantity: str,
                   product: str, price: str, tasks: int | None = None) -> DataFrame:
    """Orders, items, value and variety per customer, with the mean order value.

    Lines are first summed per order. Rows without a customer are left out.
    ``tasks`` of ``tasks_for`` keep the groups of a task bounded.
    """
    lines = lines.where(F.col(customer).isNotNull())
    slim = lines.select(customer, order, money(quantity).alias("__quantity"), value.alias("__amount"), money(price).alias("__cost"))
    per_order = dealt(slim, [customer, order], tasks).groupBy(customer, order).agg(
        F.sum("__quantity").alias("__items"), F.sum("__amount").alias("__value"),
        F.sum("__cost").alias("__price"), F.count("__cost").alias("__priced"))
    totals = per_order.groupBy(customer).agg(
        F.count(order).alias("order_count"), total("__items").alias("total_items"),
        total("__value").alias("customer_value"), ratio(F.sum("__price"), F.sum("__priced")).alias("avg_item_price"))
    variety = distinct_per_key(lines, customer, product, "product_variety", tasks)
    return attach_by_key(totals, variety, [customer]).withColumn(
        "avg_order_value", round_half_up(ratio("customer_value", "order_count")))


def market_summary(orders: DataFrame, market: str, customer: str, value: str, lines: str) -> DataFrame:
    """Customers, orders and revenue by market, from one row per order with its
    value and its number of lines. Orders are first summed per customer."""
    per_customer = orders.groupBy(market, customer).agg(
        F.count(F.lit(1)).alias("__orders"), F.sum(value).alias("__value"), F.sum(lines).alias("__lines"))
    return per_customer.groupBy(market).agg(
        F.count(customer).alias("active_customers"),
        F.sum("__orders").alias("total_orders"),
        total("__value").alias("market_revenue"),
        ratio(F.sum("__value"), F.sum("__lines")).alias("avg_transaction_value"),
    ).withColumns({
        "orders_per_customer": round_half_up(ratio("total_orders", "active_customers")),
        "revenue_per_customer": round_half_up(ratio("market_revenue", "active_customers"))})


def product_matrix(lines: DataFrame, products: DataFrame, product: str, name: str, order: str,
                   customer: str, value: Column, quantity: str, tasks: int | None = None) -> DataFrame:
    """Volume, reach and revenue per product. Lines are first summed per order, and
    names are joined to the finished totals: one row per product instead of one per line.
    ``tasks`` of ``tasks_for`` keep the groups of a task bounded."""
    slim = lines.select(product, order, money(quantity).alias("__items"), value.alias("__amount"))
    per_order = dealt(slim, [product, order], tasks).groupBy(product, order).agg(
        F.sum("__items").alias("__quantity"), F.sum("__amount").alias("__value"))
    totals = per_order.groupBy(product).agg(
        total("__quantity").alias("total_quantity"), F.count(order).alias("order_frequency"),
        total("__value").alias("total_revenue"))
    totals = attach_by_key(totals, distinct_per_key(lines, product, customer, "customer_reach", tasks), [product])
    return totals.join(products.select(product, F.col(name).alias("product_name")), product).withColumns({
        "revenue_per_unit": round_half_up(ratio("total_revenue", "total_quantity")),
        "avg_quantity_per_order": round_half_up(ratio("total_quantity", "order_frequency"))})


def weekly_summary(df: DataFrame, market: str, date: Column, year: int, order: str,
                   quantity: Column, value: Column) -> DataFrame:
    """One year by ISO week: invoices, quantity, value."""
    # A range instead of year(date), so that the filter reaches the scan.
    in_year = (date >= F.lit(f"{year}-01-01")) & (date < F.lit(f"{year + 1}-01-01"))
    return (df.where(in_year)
            .groupBy(market, F.weekofyear(date).alias("week_number"))
            .agg(F.count_distinct(order).alias("num_invoices"),
                 total(quantity).alias("total_quantity"),
                 total(value).alias("invoice_value")))


def category_performance(df: DataFrame, category: str, amount: Column, quantity: str) -> DataFrame:
    return df.groupBy(category).agg(
        F.count(F.lit(1)).alias("total_orders"), mean(amount).alias("avg_order_value"),
        F.max(amount).cast("double").alias("max_order"), F.min(amount).cast("double").alias("min_order"),
        mean(money(quantity)).alias("avg_quantity"))


def regional_performance(df: DataFrame, region: str, amount: Column) -> DataFrame:
    """Revenue is the sum itself, not mean times count."""
    return df.groupBy(region).agg(
        F.count(F.lit(1)).alias("orders"), mean(amount).alias("avg_amount"),
        total(amount).alias("total_revenue"))


def product_performance(df: DataFrame, product: str, price: str, discount: str, amount: Column) -> DataFrame:
    return df.groupBy(product).agg(
        F.count(F.lit(1)).alias("units_sold"), mean(money(price)).alias("avg_price"),
        mean(money(discount)).alias("avg_discount"), total(amount).alias("revenue"))


def frequent_customers(df: DataFrame, customer: str, amount: Column, min_orders: int = 3) -> DataFrame:
    return df.groupBy(customer).agg(
        F.count(F.lit(1)).alias("order_count"), mean(amount).alias("avg_spend"),
    ).where(F.col("order_count") >= min_orders)


def carrier_performance(df: DataFrame, carrier: str, cancelled: Column, distance: str) -> DataFrame:
    """Volume, cancellation rate and distance by carrier."""
    return df.groupBy(carrier).agg(
        F.count(F.lit(1)).alias("total_flights"), F.count_if(cancelled).alias("cancelled_flights"),
        percent(F.count_if(cancelled), F.count(F.lit(1)), 2).alias("cancellation_rate"),
        mean(money(distance)).alias("avg_distance"), F.max(distance).alias("max_distance"))


def route_performance(df: DataFrame, origin: str, dest: str, carrier: str, cancelled: Column,
                      distance: str, min_flights: int = 5, tasks: int | None = None) -> DataFrame:
    """Volume, carriers, distance and cancellations by route.

    Most routes hold a few rows, so rows are dealt by route, carrier and a salt and then by
    route: no task's groups grow with the table (``tasks`` of ``tasks_for``), and a route that
    holds many of the rows is spread over the salts."""
    slim = df.select(F.col(origin), F.col(dest), F.col(carrier), money(distance).alias("__distance"), cancelled.alias("__cancelled"))
    flown = [origin, dest, carrier, "__salt"]
    parts = dealt(with_salt(slim, ROUTE_SALTS), flown, tasks).groupBy(*flown).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__distance").alias("__sum"), F.count("__distance").alias("__known"),
        F.count_if("__cancelled").alias("__off"))
    return dealt(parts, [origin, dest], tasks).groupBy(origin, dest).agg(
        F.sum("__n").alias("flight_count"), F.count_distinct(carrier).alias("carriers_serving"),
        ratio(F.sum("__sum"), F.sum("__known")).alias("avg_distance"), F.sum("__off").alias("cancelled_count"),
    ).where(F.col("flight_count") >= min_flights)


def haul_mix(df: DataFrame, carrier: str, cancelled: Column, distance: str,
             short: float = 500, long: float = 1500) -> DataFrame:
    """Rows by distance class and the mean distance of completed rows."""
    value = F.col(distance)
    done = F.when(~cancelled, money(distance))
    return df.groupBy(carrier).agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if(value < short).alias("short_haul"),
        F.count_if(value.between(short, long)).alias("medium_haul"),
        F.count_if(value > long).alias("long_haul"),
        round_half_up(mean(done), 0).alias("avg_distance_completed"))
