"""Regression: features, split, models, scores, comparison."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import pairwise

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from brightwell.functions.bands import ERROR_BANDS, below
from brightwell.functions.numbers import round_half_up
from brightwell.operators.aggregate import dealt, tasks_for


def assemble(df: DataFrame, features: Sequence[str], output: str = "features",
             invalid: str = "skip") -> DataFrame:
    """Feature vector column; rows with a NULL feature are skipped by default."""
    return assembler(features, output, invalid).transform(df)


def assembler(features: Sequence[str], output: str = "features", invalid: str = "skip") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=invalid)


def with_split(df: DataFrame, keys: Sequence[str], train_share: float = 0.8,
               seed: int = 42, name: str = "split") -> DataFrame:
    """Mark rows train or test by a hash of the key.

    ``randomSplit`` depends on how the rows are partitioned; this split is the
    same on every run and keeps all rows of one key together.
    """
    bucket = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(10_000))
    return df.withColumn(name, F.when(bucket < int(train_share * 10_000), "train").otherwise("test"))


def train_test(df: DataFrame, keys: Sequence[str], train_share: float = 0.8,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, keys, train_share, seed, "__split")
    return (marked.where("__split = 'train'").drop("__split"),
            marked.where("__split = 'test'").drop("__split"))


def regressor(kind: str, label: str, features: str = "features", **params):
    """An untrained model by name: linear, decision_tree, random_forest or gbt."""
    common = {"featuresCol": features, "labelCol": label}
    if kind == "linear":
        return LinearRegression(**common, **params)
    if kind == "decision_tree":
        return DecisionTreeRegressor(**common, **({"seed": 42} | params))
    if kind == "random_forest":
        return RandomForestRegressor(**common, **({"numTrees": 10, "seed": 42} | params))
    if kind == "gbt":
        return GBTRegressor(**common, **({"maxIter": 10, "seed": 42} | params))
    raise ValueError(f"unknown model kind: {kind}")


MODEL_KINDS = ("linear", "decision_tree", "random_forest", "gbt")


def fit(train: DataFrame, features: Sequence[str], label: str, kind: str = "linear",
        **params) -> PipelineModel:
    return Pipeline(stages=[assembler(features), regressor(kind, label, **params)]).fit(train)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def coefficients(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    linear = model.stages[-1]
    return dict(zip(features, [float(c) for c in linear.coefficients])) | {
        "intercept": float(linear.intercept)}


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring: adds ``prediction`` to every row; NULL where a feature is NULL."""
    *_, vector, fitted = model.stages
    keeping = vector.copy().setHandleInvalid("keep")
    complete = F.lit(True)
    for name in keeping.getInputCols():
        complete = complete & F.col(name).isNotNull()
    scored = PipelineModel(stages=[keeping, fitted]).transform(df)
    return scored.withColumn("prediction", F.when(complete, F.col("prediction")))


def metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """rmse, mae and r2 in one pass over the scored rows."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("spread"))
    return sums.select(
        F.sqrt("mse").alias("rmse"), "mae",
        (F.lit(1.0) - F.try_divide("mse", "spread")).alias("r2"))


def evaluate(df: DataFrame, label: str, metric: str, prediction: str = "prediction") -> float:
    """One metric by Spark's own evaluator."""
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric).evaluate(df)


def with_error_band(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Absolute error, per cent error and its band."""
    error = F.abs(F.col(label) - F.col(prediction)).cast("double")
    percent_error = F.try_divide(error * 100, F.abs(F.col(label).cast("double")))
    return (df.withColumns({"error": error, "error_pct": percent_error})
            .withColumn("error_band", below(F.col("error_pct"), ERROR_BANDS, "Poor")))


def error_bands(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows, mean error and bias per band, without collecting the rows."""
    bias = (F.col(prediction) - F.col(label)).cast("double")
    return with_error_band(df, label, prediction).groupBy("error_band").agg(
        F.count(F.lit(1)).alias("n_rows"), round_half_up(F.avg("error")).alias("avg_error"),
        round_half_up(F.avg(bias)).alias("bias"))


def calibration(df: DataFrame, label: str, prediction: str = "prediction",
                tolerance: float = 0.05) -> DataFrame:
    """Mean prediction against mean truth."""
    return df.agg(F.avg(label).alias("avg_actual"), F.avg(prediction).alias("avg_predicted")).select(
        "*", (F.col("avg_predicted") - F.col("avg_actual")).alias("bias"),
        (F.abs(F.col("avg_predicted") - F.col("avg_actual"))
         < F.abs(F.col("avg_actual")) * tolerance).alias("well_calibrated"))


def comparable_mean(df: DataFrame, around: Mapping[str, tuple[float, float]], value: str) -> DataFrame:
    """Mean of the rows whose columns lie in the given ranges (ends included)."""
    condition: Column = F.lit(True)
    for name, (low, high) in around.items():
        condition = condition & F.col(name).between(low, high)
    return df.where(condition).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(value).alias("avg_value"))


def closed_form(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and r2 of the least-squares line, as one aggregate."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(F.regr_slope(fy, fx).alias("slope"), F.regr_intercept(fy, fx).alias("intercept"),
                  F.regr_r2(fy, fx).alias("r2"))


#: Steps of the distribution of a feature from which the edges of its bins are taken.
STEPS = 1_000


def edges(df: DataFrame, features: Sequence[str], most: int) -> dict[str, list[float]]:
    """What parts each feature into bins, ``most`` at most, as tree models do: between all
    values if they are that few, else bins of about as many rows. From all rows; values of
    less than a thousandth of the rows may share a bin with their neighbours."""
    found = df.approxQuantile(list(features), [i / STEPS for i in range(STEPS + 1)], 0.2 / STEPS)
    out = {}
    for name, steps in zip(features, found):
        values = sorted(set(steps))
        after = dict(pairwise(values))
        lows = values if len(values) <= most else [steps[i * STEPS // most] for i in range(1, most)]
        out[name] = sorted({(low + after[low]) / 2 for low in lows if low in after})
    return out


def binned(df: DataFrame, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """``df`` with features replaced by the numbers of their bins."""
    def place(name: str, at: Sequence[float]) -> Column:
        # By halving: a row is held against few of the edges.
        def among(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            mid = (low + high) // 2
            return F.when(F.col(name).cast("double") > at[mid], among(mid + 1, high)).otherwise(among(low, mid))
        return among(0, len(at))
    return df.withColumns({name: place(name, at) for name, at in cuts.items()})


def _drawn(uniform: Column, rate: float, bootstrap: bool) -> Column:
    """How often a forest's tree takes a row: a Poisson number, or once at most."""
    if not bootstrap:
        return (uniform < rate).cast("double")
    part = below_ = math.exp(-rate)
    found, k = F.when(uniform < below_, 0.0), 0
    while below_ < 1 - 1e-12:
        k += 1
        part *= rate / k
        below_ += part
        found = found.when(uniform < below_, float(k))
    return found.otherwise(k + 1.0)


def cells(df: DataFrame, features: Sequence[str], label: str, draws: Sequence[int] = (), rate: float = 1.0,
          bootstrap: bool = True) -> DataFrame:
    """(features, weight, mean) of each cell of binned features: its rows and their mean label;
    with ``draws``, seeds of draws of rows, weight0 and mean0 of the first draw, and so on."""
    value = F.col(label).cast("double")
    value = F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit("Labels MUST NOT be Null or NaN"))).otherwise(value)
    rows = df.select(*features, value.alias("__value"), *[F.rand(seed).alias(f"__u{i}") for i, seed in enumerate(draws)])
    y, found = F.col("__value"), [F.count(F.lit(1)).cast("double").alias("weight"), F.avg("__value").alias("mean")]
    for i in range(len(draws)):
        times = _drawn(F.col(f"__u{i}"), rate, bootstrap)
        found += [F.sum(times).alias(f"weight{i}"), F.try_divide(F.sum(times * y), F.sum(times)).alias(f"mean{i}")]
    return assemble(rows.groupBy(*features).agg(*found), features).drop(*features)


class Forest:
    """Trees of one forest, each fitted on its own draw of the rows."""

    def __init__(self, trees: Sequence):
        self.trees = trees

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"__tree{i}" for i in range(len(self.trees))]
        for name, tree in zip(names, self.trees):
            df = tree.transform(df, {tree.predictionCol: name})
        return df.withColumn("prediction", sum(map(F.col, names), F.lit(0.0)) / len(names)).drop(*names)


def tells_by_cells(kind: str, model) -> bool:
    """Whether the counts and mean labels of the cells are all that a model sees of the rows."""
    if kind not in ("decision_tree", "random_forest", "gbt") or model.getMinInstancesPerNode() > 1 or model.isSet("weightCol"):
        return False
    if kind == "gbt":
        return model.getSubsamplingRate() == 1 and model.getLossType() == "squared" and not model.isSet("validationIndicatorCol")
    return kind == "random_forest" or not model.isSet("varianceCol")


def fit_cells(kind: str, model, train: DataFrame, features: Sequence[str], label: str):
    """A tree model fitted on the cells of binned rows, which are ``maxBins`` to the power of
    the features at most, in place of passes over all rows for every level of every tree.

    Trees see features by their bins alone, and the gain of a split depends on counts and
    sums of the labels, so it is the same for cells. Each tree of a forest has its own draw of
    the rows, summed up by cell in the same pass."""
    draws = range(model.getSeed(), model.getSeed() + model.getNumTrees()) if kind == "random_forest" else ()
    forest = (model.getSubsamplingRate(), model.getBootstrap()) if draws else ()
    known = cells(train, features, label, draws, *forest).persist()
    try:
        if not draws:
            return model.fit(known, {model.labelCol: "mean", model.weightCol: "weight"})
        alone = {model.numTrees: 1, model.bootstrap: False, model.subsamplingRate: 1.0}
        if len(draws) > 1 and model.getFeatureSubsetStrategy() == "auto":
            alone[model.featureSubsetStrategy] = "onethird"
        return Forest([model.fit(known.where(F.col(f"weight{i}") > 0), alone | {
            model.seed: seed, model.labelCol: f"mean{i}", model.weightCol: f"weight{i}"}) for i, seed in enumerate(draws)])
    finally:
        known.unpersist()


def compare_models(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                   kinds: Sequence[str] = MODEL_KINDS, train_share: float = 0.8,
                   **params: Mapping) -> DataFrame:
    """Fit several models on the same split; one row of test metrics per model.

    The split rows are kept for all fits; each model's test metrics, four numbers, are
    fetched while they are. Rows with a NULL feature take part in neither. Rows are dealt
    out first: every pass runs on as many tasks as the kept rows have, which would else be
    those of the files. Tree models are fitted on cells of the rows (``fit_cells``) if
    all features are numbers and their parameters allow it.
    """
    names = list(dict.fromkeys([*keys, *features, label]))
    picked = assemble(dealt(df.select(*names), names, tasks_for(df)), features)
    train, test = (part.select(*dict.fromkeys([*features, label])).persist() for part in train_test(picked, keys, train_share))
    numbers = label not in features and all(isinstance(df.schema[name].dataType, NumericType) for name in features)
    cuts: dict[int, dict[str, list[float]]] = {}
    try:
        found = []
        for kind in kinds:
            model = regressor(kind, label, **params.get(kind, {}))
            if numbers and tells_by_cells(kind, model):
                most = model.getMaxBins()
                if most not in cuts:
                    cuts[most] = edges(train, features, most)
                fitted = fit_cells(kind, model, binned(train, cuts[most]), features, label)
                given = binned(test, cuts[most])
            else:
                fitted, given = model.fit(assemble(train, features).select("features", label)), test
            found.append((kind, *metrics(fitted.transform(assemble(given, features).select("features", label)), label).first()))
    finally:
        train.unpersist()
        test.unpersist()
    rmse = min((r[1] for r in found if r[1] is not None), default=None)
    r2 = max((r[3] for r in found if r[3] is not None), default=None)
    return df.sparkSession.createDataFrame(
        [(*r, r[1] == rmse, r[3] == r2) for r in found],
        "model STRING, rmse DOUBLE, mae DOUBLE, r2 DOUBLE, best_rmse BOOLEAN, best_r2 BOOLEAN")


