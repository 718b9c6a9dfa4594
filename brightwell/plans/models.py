"""Regression and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightwell.functions.numbers import n_rows, round_half_up
from brightwell.operators import candidates
from brightwell.operators import graph as g
from brightwell.operators import regression as reg
from brightwell.plans import derived
from brightwell.plans.registry import query, sql_count, sql_round

FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _predicted(t):
    """Price predicted as quantity times list price."""
    return (t.lineitem.select("l_partkey", "l_quantity", "l_extendedprice")
            .join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_extendedprice").alias("price"),
                    (F.col("l_quantity") * F.col("p_retailprice")).alias("prediction")))


_PREDICTED = """p AS (SELECT l_extendedprice AS price, l_quantity * p_retailprice AS prediction
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query("hash_split_checks", """
SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, TRUE AS share_is_close FROM lineitem""")
def hash_split_checks(t):
    # An order in both parts would be counted twice.
    parts = reg.with_split(t.lineitem, ["l_orderkey"]).groupBy("split").agg(
        n_rows().alias("n_rows"), F.count_distinct("l_orderkey").alias("n_orders"))
    return parts.agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_orders").alias("n_orders"),
        F.max(F.when(F.col("split") == "train", F.col("n_rows"))).alias("train")).select(
        "n_rows", "n_orders", (F.abs(F.col("train") / F.col("n_rows") - 0.8) < 0.05).alias("share_is_close"))


@query("linreg_coefficients", f"""
WITH c AS (SELECT avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my,
  var_pop(l_quantity) AS s11, var_pop(l_discount) AS s22, covar_pop(l_quantity, l_discount) AS s12,
  covar_pop(l_quantity, l_extendedprice) AS s1y, covar_pop(l_discount, l_extendedprice) AS s2y FROM lineitem),
b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
  (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM c)
SELECT 'l_quantity' AS name, {sql_round('b1', 3)} AS weight FROM b
UNION ALL SELECT 'l_discount', {sql_round('b2', 3)} FROM b
UNION ALL SELECT 'intercept', {sql_round('my - b1 * m1 - b2 * m2', 3)} FROM b""")
def linreg_coefficients(t):
    features = ["l_quantity", "l_discount"]
    model = reg.fit(t.lineitem.select(*features, "l_extendedprice"), features, "l_extendedprice")
    found = t.spark.createDataFrame(list(reg.coefficients(model, features).items()), "name STRING, weight DOUBLE")
    return found.select("name", round_half_up("weight", 3).alias("weight"))


@query("linreg_predict", f"""
WITH l AS (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END AS q FROM lineitem),
f AS (SELECT regr_slope(l_extendedprice, q) AS a, regr_intercept(l_extendedprice, q) AS b FROM l WHERE l_orderkey % 5 <> 0)
SELECT l_orderkey, l_linenumber, l_partkey, {sql_round('a * q + b', 3)} AS prediction FROM l, f""")
def linreg_predict(t):
    """Fit on the orders whose key is not divisible by 5, score all lines; those
    without the feature get no prediction, but stay."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.when(
        F.col("l_orderkey") % 3 != 0, F.col("l_quantity")).alias("q"))
    model = reg.fit(lines.where("l_orderkey % 5 <> 0"), ["q"], "l_extendedprice", solver="normal")
    return reg.score(model, lines).select("l_orderkey", "l_linenumber", "l_partkey",
                                          round_half_up("prediction", 3).alias("prediction"))


@query("linreg_1d", f"""
SELECT {sql_round('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope,
  {sql_round('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept,
  {sql_round('regr_r2(l_extendedprice, l_quantity)', 6)} AS r2 FROM lineitem""")
def linreg_1d(t):
    line = reg.closed_form(t.lineitem, "l_quantity", "l_extendedprice")
    return line.select(round_half_up("slope", 4).alias("slope"), round_half_up("intercept", 4).alias("intercept"),
                       round_half_up("r2", 6).alias("r2"))


@query("regression_metrics", f"""
WITH {_PREDICTED} SELECT {sql_round('sqrt(avg((price - prediction) ** 2))', 4)} AS rmse,
  {sql_round('avg(abs(price - prediction))', 4)} AS mae,
  {sql_round('1 - avg((price - prediction) ** 2) / var_pop(price)', 6)} AS r2 FROM p""")
def regression_metrics(t):
    found = reg.metrics(_predicted(t), "price")
    return found.select(round_half_up("rmse", 4).alias("rmse"), round_half_up("mae", 4).alias("mae"),
                        round_half_up("r2", 6).alias("r2"))


@query("prediction_bands", f"""
WITH {_PREDICTED}, e AS (SELECT *, abs(price - prediction) AS error, abs(price - prediction) * 100 / abs(price) AS pct FROM p)
SELECT CASE WHEN pct < 10 THEN 'Excellent' WHEN pct < 20 THEN 'Good' WHEN pct < 30 THEN 'Fair' ELSE 'Poor' END AS error_band,
  count(*) AS n_rows, {sql_round('avg(error)')} AS avg_error, {sql_round('avg(prediction - price)')} AS bias FROM e GROUP BY 1""")
def prediction_bands(t):
    return reg.error_bands(_predicted(t), "price")


@query("calibration", f"""
WITH {_PREDICTED} SELECT {sql_round('avg(price)')} AS avg_actual, {sql_round('avg(prediction)')} AS avg_predicted,
  abs(avg(prediction) - avg(price)) < abs(avg(price)) * 0.05 AS well_calibrated FROM p""")
def calibration(t):
    return reg.calibration(_predicted(t), "price").select(
        round_half_up("avg_actual").alias("avg_actual"), round_half_up("avg_predicted").alias("avg_predicted"),
        "well_calibrated")


@query("comparable_rows", f"""
SELECT count(*) AS n_rows, {sql_round('avg(l_extendedprice)')} AS avg_value FROM lineitem
WHERE l_quantity BETWEEN 20 AND 25 AND l_discount BETWEEN 0.02 AND 0.04""")
def comparable_rows(t):
    found = reg.comparable_mean(t.lineitem, {"l_quantity": (20, 25), "l_discount": (0.02, 0.04)}, "l_extendedprice")
    return found.select("n_rows", round_half_up("avg_value").alias("avg_value"))


@query("model_comparison", """
SELECT unnest(['decision_tree', 'gbt', 'linear', 'random_forest']) AS model, TRUE AS is_finite, 1 AS n_best_rmse, TRUE AS best_agree""")
def model_comparison(t):
    """Four fitted models: finite metrics, one best, the same by either measure."""
    found = reg.compare_models(t.lineitem, FEATURES, "l_extendedprice", ["l_orderkey"])
    return found.select(
        "model", ((F.col("rmse") > 0) & (F.col("mae") > 0) & (F.col("mae") <= F.col("rmse")) & (F.col("r2") <= 1)).alias("is_finite"),
        found.agg(F.count_if("best_rmse").cast("int")).scalar().alias("n_best_rmse"),
        (F.col("best_rmse") == F.col("best_r2")).alias("best_agree"))


@query("graph_stats", f"""
WITH {derived.SQL_TRADE} SELECT (SELECT count(*) FROM vertices) AS n_vertices, (SELECT count(*) FROM edges) AS n_edges,
  2.0 * (SELECT count(*) FROM edges) / (SELECT count(*) FROM vertices) AS mean_degree""")
def graph_stats(t):
    return g.statistics(derived.trade_graph(t))


@query("graph_neighbours", f"""
WITH {derived.SQL_TRADE} SELECT DISTINCT id, name FROM edges JOIN vertices ON dst = id WHERE src = 'C7'""")
def graph_neighbours(t):
    return g.neighbours(derived.trade_graph(t), "C7")


@query("graph_degree", f"""
WITH {derived.SQL_TRADE} SELECT id, name, count(*) AS count FROM edges JOIN vertices ON src = id GROUP BY ALL""")
def graph_degree(t):
    return g.out_degrees(derived.trade_graph(t))


@query("graph_total_degree", f"""
WITH {derived.SQL_TRADE}, ends AS (SELECT src AS v FROM edges UNION ALL SELECT dst FROM edges)
SELECT id, name, count(v) AS degree FROM vertices LEFT JOIN ends ON id = v GROUP BY ALL""")
def graph_total_degree(t):
    return g.total_degrees(derived.trade_graph(t))


@query("graph_named_edges", f"""
WITH {derived.SQL_PLACES} SELECT s.name AS src_name, d.name AS dst_name
FROM edges JOIN vertices s ON src = s.id JOIN vertices d ON dst = d.id""")
def graph_named_edges(t):
    return g.named_edges(derived.place_graph(t))


@query("graph_two_hop", f"""
WITH {derived.SQL_PLACES} SELECT DISTINCT a.src, b.dst FROM edges a JOIN edges b ON a.dst = b.src AND a.src <> b.dst
WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.src = a.src AND e.dst = b.dst)""")
def graph_two_hop(t):
    return g.link_candidates(derived.place_graph(t))


@query("graph_checks", f"""
WITH {derived.SQL_TRADE} SELECT {sql_count('src NOT IN (SELECT id FROM vertices) OR dst NOT IN (SELECT id FROM vertices)')}
  AS dangling_edges, (SELECT count(*) - count(DISTINCT id) FROM vertices) AS duplicate_vertices FROM edges""")
def graph_checks(t):
    graph = derived.trade_graph(t)
    return graph.dangling_edges().agg(n_rows().alias("dangling_edges")).withColumn(
        "duplicate_vertices", graph.duplicate_vertices().agg(n_rows()).scalar())


@query("triangle_count", f"""
WITH {derived.SQL_TRADE}, u AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst)
SELECT count(*) AS n_triangles FROM u x JOIN u y ON x.b = y.a JOIN u z ON x.a = z.a AND y.b = z.b""")
def triangle_count(t):
    return g.triangle_count(derived.trade_graph(t).edges)


@query("connected_components", f"""
WITH RECURSIVE {derived.SQL_PLACES}, up AS (SELECT id, id AS root FROM vertices UNION ALL
  SELECT up.id, e.dst FROM up JOIN edges e ON e.src = up.root),
roots AS (SELECT id, root FROM up WHERE root LIKE 'R%'),
names AS (SELECT root, min(id) AS component FROM roots GROUP BY root)
SELECT id, component FROM roots JOIN names USING (root)""")
def connected_components(t):
    return g.connected_components(derived.place_graph(t))


def _rank_sql(rounds: int) -> str:
    """PageRank written out round by round."""
    steps = "r0 AS (SELECT DISTINCT id, CAST(1 AS DOUBLE) AS rank FROM vertices)"
    for i in range(1, rounds + 1):
        steps += f""", r{i} AS (SELECT v.id, 0.15 + 0.85 * (COALESCE(g.got, 0)
  + (SELECT COALESCE(sum(rank), 0) FROM r{i - 1} WHERE id NOT IN (SELECT src FROM edges))
    / (SELECT count(*) FROM r0)) AS rank
  FROM r{i - 1} v LEFT JOIN (SELECT e.dst, sum(r.rank / o.n) AS got FROM edges e JOIN r{i - 1} r ON r.id = e.src
    JOIN (SELECT src, count(*) AS n FROM edges GROUP BY src) o ON o.src = e.src GROUP BY e.dst) g ON g.dst = v.id)"""
    return f"WITH {derived.SQL_PLACES}, {steps} SELECT id, {sql_round('rank', 6)} AS rank FROM r{rounds}"


@query("page_rank", _rank_sql(10))
def page_rank(t):
    return g.page_rank(derived.place_graph(t)).select("id", round_half_up("rank", 6).alias("rank"))


@query("graph_scored_links", """
WITH e AS (SELECT 'C' || l.c AS x, 'P' || l.p AS y FROM (SELECT DISTINCT o_custkey AS c, l_partkey AS p FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_quantity >= 40) l
  UNION SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer UNION SELECT 'C' || c_custkey, c_mktsegment FROM customer),
links AS (SELECT least(x, y) AS a, greatest(x, y) AS b FROM e), both_ways AS (SELECT a AS c, b AS v FROM links UNION ALL SELECT b, a FROM links)
SELECT p.v AS a, q.v AS b, count(*) AS common FROM both_ways p JOIN both_ways q ON p.c = q.c AND p.v < q.v
WHERE NOT EXISTS (SELECT 1 FROM links WHERE links.a = p.v AND links.b = q.v)
GROUP BY p.v, q.v ORDER BY common DESC, p.v, q.v LIMIT 200""")
def graph_scored_links(t):
    """The 200 pairs that share most of parts sent back, nation and segment."""
    def end(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))
    back = t.lineitem.where("l_returnflag = 'R' AND l_quantity >= 40").join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    edges = (back.select(end("C", "o_custkey").alias("src"), end("P", "l_partkey").alias("dst"))
             .union(t.customer.select(end("C", "c_custkey"), end("N", "c_nationkey")))
             .union(t.customer.select(end("C", "c_custkey"), "c_mktsegment")))
    return candidates.scored_links(edges, 200)
