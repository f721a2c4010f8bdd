"""Demand models trained and scored with MLlib.

Every model has the same three parts: a label expression, a pipeline that ends in a raw
prediction, and an output expression. Fits aggregate statistics over the executors; only
tree nodes or coefficients reach the driver.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import zip_longest
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FEATURES, TARGET
from .evaluation import error_metrics, naive_week_lag

SEED = 42
#: Fits that run at the same time.
MOST_AT_ONCE = 6
_LABEL, _RAW, _VECTOR = "_label", "_raw_prediction", "_features"
# Fixed value: rows of the importance report.
TOP_FEATURES = 20


@dataclass(frozen=True)
class ModelSpec:
    """A forecaster before fitting."""

    model_type: str
    estimator: Callable[[DataFrame], Estimator]
    label_sql: str = "CAST({target} AS DOUBLE)"
    output_sql: str = "{raw}"
    features: tuple[str, ...] = FEATURES
    target: str = TARGET
    patience: int | None = None
    params: Mapping[str, object] = field(default_factory=dict)

    def fit(self, train: DataFrame, val: DataFrame | None = None) -> FittedModel:
        """Fit on ``train``; with a patience and validation rows, keep the trees up to the best round."""
        assembler = VectorAssembler(inputCols=list(self.features), outputCol=_VECTOR)

        def rows_of(df: DataFrame) -> DataFrame:
            # Only the columns a fit needs are shuffled and cached by the learner.
            return df.select(*self.features, F.expr(self.label_sql.format(target=self.target)).alias(_LABEL))

        rows = rows_of(train)
        learner = self.estimator(rows)
        ready = assembler.transform(rows)
        if self.patience and val is not None and not val.isEmpty():
            model = stopped_early(learner, ready, assembler.transform(rows_of(val)), self.patience)
        else:
            model = learner.fit(ready)
        out = self.output_sql.format(raw=_RAW)
        shown = SQLTransformer(statement=f"SELECT *, {out} AS prediction FROM __THIS__")
        return FittedModel(self.model_type, PipelineModel([assembler, model, shown]), self.features, self.target)


def stopped_early(learner: GBTRegressor, train: DataFrame, val: DataFrame, patience: int) -> GBTRegressionModel:
    """The trees up to the best validation round.

    Each round has a seed of its own, so a short fit is a prefix of a long one: the long fit is only grown if the best
    round of the short one may still be beaten within the patience.
    """
    most = learner.getMaxIter()
    for rounds in sorted({min(patience + 1, most), most}):
        model = learner.copy({learner.maxIter: rounds}).fit(train)
        best = best_round(model.evaluateEachIteration(val, "squared"), patience)
        if best + patience <= rounds:
            break
    return first_trees(model, best) if best < rounds else model


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model's first ``n`` trees: what a fit of ``n`` rounds with the same seed grows."""
    old, jvm = model._java_obj, SparkContext._active_spark_context._jvm
    kind = jvm.org.apache.spark.ml.regression
    trees = SparkContext._gateway.new_array(kind.DecisionTreeRegressionModel, n)
    weights = SparkContext._gateway.new_array(jvm.double, n)
    for i, (tree, weight) in enumerate(zip(model.trees[:n], model.treeWeights[:n], strict=True)):
        trees[i], weights[i] = tree._java_obj, weight
    short = GBTRegressionModel(kind.GBTRegressionModel(old.uid(), trees, weights))
    return short.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def best_round(errors: Sequence[float], patience: int) -> int:
    """Number of rounds up to the smallest validation error, looking no further than ``patience`` rounds past it."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


@dataclass(frozen=True)
class FittedModel:
    model_type: str
    pipeline: PipelineModel
    features: tuple[str, ...] = FEATURES
    target: str = TARGET

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        scored = self.pipeline.transform(df).drop(_VECTOR, _RAW)
        return scored if name == "prediction" else scored.withColumnRenamed("prediction", name)

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    def importances(self, spark: SparkSession, top: int = TOP_FEATURES) -> DataFrame:
        """Gain share per feature, largest first (one row per model input)."""
        weights = self.pipeline.stages[1].featureImportances.toArray()
        # A vector of trees alone ends with the last feature they split on.
        pairs = [(f, float(w)) for f, w in zip_longest(self.features, weights, fillvalue=0.0)]
        table = spark.createDataFrame(pairs, "feature string, importance double")
        return table.orderBy(F.col("importance").desc(), "feature").limit(top)


def load_model(path: str, model_type: str = "saved") -> FittedModel:
    pipeline = PipelineModel.load(path)
    return FittedModel(model_type, pipeline, tuple(pipeline.stages[0].getInputCols()))


def _trees(params: Mapping[str, object]) -> Callable[[DataFrame], Estimator]:
    def build(_: DataFrame) -> Estimator:
        return GBTRegressor(featuresCol=_VECTOR, labelCol=_LABEL, predictionCol=_RAW, seed=SEED, **params)

    return build


# Defaults of the boosted models.
BOOSTING = {"maxIter": 120, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8, "minInstancesPerNode": 20, "maxBins": 64}
# Fixed value: rounds without a better validation error before a fit counts as finished.
PATIENCE = 50


def boosted_log(features: Sequence[str] = FEATURES, **overrides) -> ModelSpec:
    """Boosted trees on log1p of the target, early stop on validation, output clipped at 0."""
    params = BOOSTING | overrides
    return ModelSpec(
        "boosted_log", _trees(params), "log1p(CAST({target} AS DOUBLE))", "greatest(expm1({raw}), 0.0D)",
        tuple(features), patience=PATIENCE, params=params,
    )


def boosted_raw(features: Sequence[str] = FEATURES, **overrides) -> ModelSpec:
    """Boosted trees on the plain target; the output is not clipped."""
    params = BOOSTING | overrides
    return ModelSpec("boosted_raw", _trees(params), features=tuple(features), patience=PATIENCE, params=params)


def ridge(alpha: float = 1.0, features: Sequence[str] = FEATURES, standardise: bool = True, target: str = TARGET) -> ModelSpec:
    """Least squares with penalty ``alpha * |w|^2`` on (standardised) features, clipped at 0.

    MLlib's penalty is per row and relative to the label's deviation; the two scalars that
    convert ``alpha`` come from one aggregate.
    """

    def build(rows: DataFrame) -> Estimator:
        row = rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(_LABEL).alias("sd")).first()
        return LinearRegression(
            featuresCol=_VECTOR, labelCol=_LABEL, predictionCol=_RAW, elasticNetParam=0.0, solver="normal",
            standardization=standardise, regParam=alpha / row.n * (row.sd or 0.0),
        )

    return ModelSpec("ridge", build, output_sql="greatest({raw}, 0.0D)", features=tuple(features), target=target, params={"alpha": alpha})


def compare_models(specs: Sequence[ModelSpec], train: DataFrame, val: DataFrame, test: DataFrame) -> list[dict]:
    """Validation and test errors per candidate; one result row per model, not per record."""
    out = []
    for spec in specs:
        model = spec.fit(train, val)
        row = {"model_type": spec.model_type, "n_features": len(spec.features)}
        for part, df in (("val", val), ("test", test)):
            m = error_metrics(model.predict(df), spec.target).first()
            row |= {f"{part}_mae": m.mae, f"{part}_rmse": m.rmse, f"{part}_mape": m.mape}
        out.append(row)
    return out


def ablation(sets: Mapping[str, Sequence[str]], make: Callable[[Sequence[str]], ModelSpec], train: DataFrame, val: DataFrame, test: DataFrame) -> list[dict]:
    """One fit per feature subset; subsets with unknown columns are skipped."""
    known = {name: tuple(subset) for name, subset in sets.items() if set(subset) <= set(train.columns)}
    distinct = list(dict.fromkeys(known.values()))  # two of the subsets are equal today

    def error(subset: tuple[str, ...]) -> float:
        return error_metrics(make(subset).fit(train, val).predict(test)).first().mape

    fits = dict(zip(distinct, at_once(train.sparkSession, error, distinct), strict=True))
    return [{"variant": name, "n_features": len(subset), "test_mape": fits[subset]} for name, subset in known.items()]


def at_once(spark: SparkSession, run: Callable, items: Sequence) -> list:
    """``run`` of each item, as concurrent Spark jobs: a fit is many short jobs that leave most cores idle alone."""
    if not items:
        return []
    with ThreadPool(min(len(items), MOST_AT_ONCE)) as pool:
        return pool.map(inheritable_thread_target(spark)(run), list(items), 1)


# Search ranges, expressed with MLlib's parameters.
SEARCH_SPACE = {
    "stepSize": ("log", 0.01, 0.15),
    "maxDepth": ("int", 4, 8),
    "minInstancesPerNode": ("int", 10, 120),
    "subsamplingRate": ("float", 0.6, 1.0),
    "maxBins": ("int", 32, 128),
}


def search_trials(n: int, seed: int = SEED) -> list[dict]:
    """Seeded random parameter sets."""
    rng = random.Random(seed)
    trials = []
    for _ in range(n):
        params: dict[str, object] = {}
        for name, (kind, low, high) in SEARCH_SPACE.items():
            if kind == "int":
                params[name] = rng.randint(low, high)
            elif kind == "log":
                params[name] = low * (high / low) ** rng.random()
            else:
                params[name] = rng.uniform(low, high)
        trials.append(params)
    return trials


def search(trials: Sequence[dict], train: DataFrame, val: DataFrame, test: DataFrame, **fixed) -> list[dict]:
    """Fit all trials and rank them by validation error; the test error is only reported.

    The trials run as concurrent Spark jobs on the same saved matrix.
    """

    def run(numbered: tuple[int, dict]) -> dict:
        number, params = numbered
        model = boosted_log(**(params | fixed)).fit(train, val)
        val_m, test_m = error_metrics(model.predict(val)).first(), error_metrics(model.predict(test)).first()
        return {"trial": number, "val_mape": val_m.mape, "test_mape": test_m.mape} | {k: float(v) for k, v in params.items()}

    results = at_once(train.sparkSession, run, list(enumerate(trials)))
    return sorted(results, key=lambda r: (r["val_mape"], r["trial"]))


def baseline_mape(test: DataFrame) -> float:
    return error_metrics(naive_week_lag(test)).first().mape
