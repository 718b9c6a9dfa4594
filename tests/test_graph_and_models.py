import itertools
import random

import pytest
from pyspark.sql import functions as F

from brightwell.operators import graph as g
from brightwell.operators import regression as reg
from tests.conftest import rows


@pytest.fixture(scope="module")
def friends(spark):
    vertices = spark.createDataFrame([("1", "Ada", 51), ("2", "Ben", 19), ("3", "Cleo", 27), ("4", "Dan", 44),
                                      ("5", "Eli", 36), ("6", "Fay", 62)], "id STRING, name STRING, age LONG")
    edges = spark.createDataFrame([("1", "2"), ("1", "3"), ("2", "3"), ("2", "4"), ("3", "5"), ("5", "6"), ("4", "6")],
                                  "src STRING, dst STRING")
    return g.Graph(vertices, edges)


def test_friend_graph(friends):
    assert rows(g.statistics(friends)) == [(6, 7, 14 / 6)]
    assert rows(g.neighbours(friends, "1"), "name") == [("Ben",), ("Cleo",)]
    assert dict(rows(g.out_degrees(friends), "name", "count")) == {"Ada": 2, "Ben": 2, "Cleo": 1, "Dan": 1, "Eli": 1}
    assert dict(rows(g.total_degrees(friends), "name", "degree"))["Ben"] == 3
    assert ("Eli", "Fay") in rows(g.named_edges(friends))
    assert rows(g.link_candidates(friends)) == [("1", "4"), ("1", "5"), ("2", "5"), ("2", "6"), ("3", "6")]
    assert ("1", "3") in rows(g.link_candidates(friends, only_new=False))
    assert rows(g.triangle_count(friends.edges)) == [(1,)]


def test_graph_checks(spark, friends):
    broken = g.Graph(friends.vertices.union(friends.vertices.limit(1)),
                     friends.edges.union(spark.createDataFrame([("1", "9"), ("9", "9")], "src STRING, dst STRING")))
    assert rows(broken.dangling_edges()) == [("1", "9"), ("9", "9")]
    assert broken.duplicate_vertices().count() == 1
    with pytest.raises(ValueError):
        g.Graph(friends.edges, friends.vertices)


def test_triangles_and_components_against_brute_force(spark):
    rng = random.Random(3)
    pairs = {(rng.randrange(30), rng.randrange(60)) for _ in range(120)} | {(0, i) for i in range(60)}
    pairs |= {(100 + i, 101 + i) for i in range(20)} | {(5, 5)}
    links = {frozenset(p) for p in pairs if p[0] != p[1]}
    nodes = sorted({v for p in pairs for v in p} | {999})
    brute = sum(1 for a, b, c in itertools.combinations(nodes, 3)
                if {frozenset((a, b)), frozenset((b, c)), frozenset((a, c))} <= links)
    edges = spark.createDataFrame(sorted(pairs), "src LONG, dst LONG")
    assert rows(g.triangle_count(edges.union(edges))) == [(brute,)]
    label = {v: v for v in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in map(tuple, links):
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    vertices = spark.createDataFrame([(v, str(v)) for v in nodes], "id LONG, name STRING")
    assert dict(rows(g.connected_components(g.Graph(vertices, edges)))) == label


def test_page_rank_against_python(friends):
    ranks = {v: 1.0 for v, in rows(friends.vertices, "id")}
    edges = rows(friends.edges)
    out = {v: [d for s, d in edges if s == v] for v in ranks}
    for _ in range(6):
        loose = sum(r for v, r in ranks.items() if not out[v]) / len(ranks)
        ranks = {v: 0.15 + 0.85 * (sum(ranks[s] / len(out[s]) for s, d in edges if d == v) + loose) for v in ranks}
    got = dict(rows(g.page_rank(friends, 6)))
    assert got == pytest.approx(ranks)
    assert sum(got.values()) == pytest.approx(6)


HOUSES = [(800 + 37 * i, 1 + i % 4, 1 + i % 3, i % 25) for i in range(120)]


@pytest.fixture(scope="module")
def houses(spark):
    data = [(i, a, b, c, d, 50_000.0 + 120.0 * a + 9_000.0 * b + 5_000.0 * c - 700.0 * d)
            for i, (a, b, c, d) in enumerate(HOUSES)]
    return spark.createDataFrame(data, "id LONG, area LONG, bedrooms LONG, bathrooms LONG, age LONG, price DOUBLE")


FEATURES = ["area", "bedrooms", "bathrooms", "age"]


def test_linear_regression_finds_the_formula(houses, tmp_path):
    train, test = reg.train_test(houses, ["id"])
    assert train.count() + test.count() == 120 and train.join(test, "id").count() == 0
    again, _ = reg.train_test(houses.repartition(7), ["id"])
    assert rows(again, "id") == rows(train, "id")
    model = reg.fit(train, FEATURES, "price")
    found = reg.coefficients(model, FEATURES)
    assert found == pytest.approx({"area": 120, "bedrooms": 9000, "bathrooms": 5000, "age": -700, "intercept": 50000}, rel=1e-6)
    scored = reg.score(model, test)
    one = reg.metrics(scored, "price").first()
    for name in ("rmse", "mae", "r2"):
        assert one[name] == pytest.approx(reg.evaluate(scored, "price", name), abs=1e-6)
    reg.save_model(model, str(tmp_path / "model"))
    loaded = reg.score(reg.load_model(str(tmp_path / "model")), test)
    assert rows(loaded, "id", "prediction") == rows(scored, "id", "prediction")
    assert dict(rows(reg.error_bands(scored, "price"), "error_band", "n_rows")) == {"Excellent": test.count()}
    assert reg.calibration(scored, "price").first()["well_calibrated"]


def test_links_are_made_from_the_edges_once(spark, friends, monkeypatch):
    kept, cut = [], g.cut_lineage
    monkeypatch.setattr(g, "cut_lineage", lambda df: kept.append(df.columns) or cut(df))
    made = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    edges = friends.edges.coalesce(1).mapInPandas(watched, "src STRING, dst STRING")
    assert rows(g.triangle_count(edges)) == [(1,)]
    assert made.value == 7 and kept[0] == ["a", "b"]


def test_metrics_with_real_errors(spark):
    df = spark.createDataFrame([(100.0, 105.0), (200.0, 170.0), (300.0, 225.0), (0.0, 1.0), (50.0, 100.0)], "price DOUBLE, prediction DOUBLE")
    one = reg.metrics(df, "price").first()
    for name in ("rmse", "mae", "r2"):
        assert one[name] == pytest.approx(reg.evaluate(df, "price", name))
    bands = dict(rows(reg.with_error_band(df, "price").groupBy("error_band").count()))
    assert bands == {"Excellent": 1, "Good": 1, "Fair": 1, "Poor": 2}


def test_model_comparison(houses):
    table = reg.compare_models(houses, FEATURES, "price", ["id"])
    assert {r[0] for r in rows(table, "model")} == set(reg.MODEL_KINDS)
    assert rows(table.where("best_rmse"), "model") == [("linear",)] == rows(table.where("best_r2"), "model")


def test_models_are_fitted_on_rows_dealt_out(spark, houses, monkeypatch):
    """A table read by one task is not fitted by one task."""
    real, seen = reg.regressor, []

    class Watched:
        def __init__(self, *args, **params):
            self.inner = real(*args, **params)

        def fit(self, train):
            seen.append(train.rdd.getNumPartitions())
            return self.inner.fit(train)

    monkeypatch.setattr(reg, "regressor", Watched)
    reg.compare_models(houses.coalesce(1), FEATURES, "price", ["id"], ["linear"])
    assert seen == [spark.sparkContext.defaultParallelism]


TREES = ["decision_tree", "random_forest", "gbt"]


@pytest.fixture(scope="module")
def flats(spark):
    return spark.range(6000).selectExpr(
        "id", "cast(id * 7 % 20 AS DOUBLE) AS rooms", "cast(id * 13 % 31 AS DECIMAL(6,2)) AS floor", "id * 0.37 AS width",
        "id * 7 % 20 * 3.0 + pow(id * 13 % 31, 2) + id * 7919 % 101 AS price")


def test_tree_models_are_fitted_on_cells(flats, monkeypatch):
    """Every pass of every tree would read all rows; cells are bounded by the bins."""
    real, seen = reg.regressor, []

    def watched(kind, label, **params):
        model = real(kind, label, **params)
        fit = model.fit
        model.fit = lambda train, *more: seen.append(train.count()) or fit(train, *more)
        return model

    monkeypatch.setattr(reg, "regressor", watched)
    reg.compare_models(flats, ["rooms", "width"], "price", ["id"], TREES, **{kind: {"maxBins": 8} for kind in TREES})
    assert len(seen) == 12 and max(seen) <= 64
    seen.clear()
    reg.compare_models(flats, ["rooms", "width"], "price", ["id"], ["gbt", "decision_tree"], gbt={"subsamplingRate": 0.5}, decision_tree={"minInstancesPerNode": 2})
    assert min(seen) > 4000


def test_cells_give_the_trees_that_rows_give(flats):
    features = ["rooms", "floor"]
    train, test = (reg.assemble(part, features) for part in reg.train_test(flats, ["id"]))
    found = {r["model"]: r for r in reg.compare_models(flats, features, "price", ["id"], TREES).collect()}
    for kind in TREES:
        wanted = reg.metrics(reg.regressor(kind, "price").fit(train).transform(test), "price").first()
        for name in ("rmse", "mae", "r2"):
            # A forest draws its rows at random.
            assert found[kind][name] == pytest.approx(wanted[name], rel=0.25 if kind == "random_forest" else 1e-6)


def test_cells_hold_all_rows(spark, flats):
    cuts = reg.edges(flats, ["rooms", "width"], 32)
    assert cuts["rooms"] == [i + 0.5 for i in range(19)] and len(cuts["width"]) == 31
    placed = reg.binned(flats, cuts)
    sizes = [r["n"] for r in placed.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 32 and sum(sizes) == 6000 and max(sizes) < 250
    known = reg.cells(placed, ["rooms", "width"], "price", [1, 2]).toPandas()
    plain = flats.agg(F.sum("price")).first()[0]
    assert known["weight"].sum() == 6000 and (known["weight"] * known["mean"]).sum() == pytest.approx(plain)
    for i in (0, 1):
        drawn = known[known[f"weight{i}"] > 0]
        assert 5600 < drawn[f"weight{i}"].sum() < 6400 and (drawn[f"weight{i}"] * drawn[f"mean{i}"]).sum() == pytest.approx(plain, rel=0.1)
    assert list(known["weight0"]) != list(known["weight1"])
    assert reg.edges(spark.sql("SELECT 1.0 AS rooms"), ["rooms"], 32) == {"rooms": []}
    with pytest.raises(Exception, match="Labels"):
        reg.cells(placed.withColumn("price", F.nullif("price", "price")), ["rooms"], "price").collect()


def test_closed_form_and_comparables(houses):
    line = reg.closed_form(houses.selectExpr("area AS x", "3.0 * area + 2 AS y"), "x", "y").first()
    assert (line["slope"], line["intercept"], line["r2"]) == pytest.approx((3, 2, 1))
    near = reg.comparable_mean(houses, {"area": (800, 874), "bedrooms": (1, 2)}, "price").first()
    assert near["n_rows"] == houses.where(F.col("area").isin(800, 837)).count() == 2
