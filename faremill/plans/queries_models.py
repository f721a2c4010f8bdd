"""Queries that fit and score models (compared by row count and by tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ensembles, evaluation, features, models, splits
from ..operators.registry import ModelRegistry
from ..schema import FEATURES
from ..session import materialise, scratch_path
from ..sources import tables
from . import forecast
from .catalog import hourly_of, register
from .queries_features import KEYS, RUN_DATE

LOOKBACK = 24 * 60  # the test panel has many empty zone-hours
# Search trials, each a whole fit; raise it where a search may take longer.
TRIALS = 4


def _parts(spark, sf_dir):
    matrix = forecast.training_matrix(hourly_of(spark, sf_dir), RUN_DATE)
    return forecast.parts(matrix, RUN_DATE)


def _scored(spark, sf_dir, spec):
    train, val, test = _parts(spark, sf_dir)
    return spec.fit(train, val).predict(test).select(*KEYS, "trip_count", "prediction")


def _least_rows(hourly):
    """Rows the matrix gate asks for: a quarter of the panel (lags take the rest).

    The matrix has a row a zone and hour however many vendors served it, so vendors are not counted.
    """
    return features.demand_panel(hourly).count() // 4


def _rows(spark, rows, ddl):
    names = [c.split()[0] for c in ddl.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)


@register("boosted_log_forecast")
def _boosted_log(spark, sf_dir):
    """Boosted trees on the log target, clipped."""
    return _scored(spark, sf_dir, models.boosted_log())


@register("boosted_raw_forecast")
def _boosted_raw(spark, sf_dir):
    """Boosted trees on the plain target, not clipped."""
    return _scored(spark, sf_dir, models.boosted_raw())


@register("ridge_forecast")
def _ridge(spark, sf_dir):
    """Ridge regression on standardised features."""
    return _scored(spark, sf_dir, models.ridge(1.0))


@register("model_comparison")
def _comparison(spark, sf_dir):
    """Errors of the three candidates on validation and test rows."""
    rows = models.compare_models([models.boosted_log(), models.boosted_raw(), models.ridge(1.0)], *_parts(spark, sf_dir))
    return _rows(spark, rows, "model_type string, n_features int, val_mae double, val_rmse double, val_mape double, test_mae double, test_rmse double, test_mape double")


@register("feature_ablation")
def _ablation(spark, sf_dir):
    """Test error per feature subset."""
    rows = models.ablation(evaluation.ABLATION_SETS, lambda subset: models.boosted_log(subset), *_parts(spark, sf_dir))
    return _rows(spark, rows, "variant string, n_features int, test_mape double")


@register("parameter_search")
def _search(spark, sf_dir):
    """Seeded trials ranked by validation error, each with its gain over the default parameters."""
    train, val, test = _parts(spark, sf_dir)

    def default_error():
        return evaluation.error_metrics(models.boosted_log().fit(train, val).predict(test)).first().mape

    fits = [default_error, lambda: models.search(models.search_trials(TRIALS), train, val, test)]
    default, rows = models.at_once(spark, lambda fit: fit(), fits)
    for row in rows:
        row |= {"gain": default - row["test_mape"], "passes": evaluation.gain_passes(default, row["test_mape"], evaluation.SEARCH_GAIN)}
    return _rows(spark, rows, "trial int, val_mape double, test_mape double, gain double, passes boolean, stepSize double, maxDepth double, minInstancesPerNode double, subsamplingRate double, maxBins double")


@register("walk_forward_fitted")
def _walk_forward(spark, sf_dir):
    """Ridge refitted on every fold."""
    matrix = forecast.training_matrix(hourly_of(spark, sf_dir), RUN_DATE)
    return _rows(spark, forecast.walk_forward_errors(matrix, RUN_DATE, models.ridge(1.0)), "fold int, mape double")


@register("promotion_decision")
def _promotion(spark, sf_dir):
    """Walk-forward and test errors of a registered version, its gates, the decision and the alias it leads to."""
    hourly = materialise(hourly_of(spark, sf_dir), "hourly")
    registry = ModelRegistry(spark, scratch_path(spark, "promotion"))
    result = forecast.train(spark, hourly, RUN_DATE, registry, min_rows=_least_rows(hourly))
    row = forecast.promote(hourly, RUN_DATE, registry, result, models.boosted_log())
    return _rows(spark, [row], "version int, cv_mape_mean double, cv_mape_std double, test_mape double, baseline_mape double,"
                 " stable boolean, beats_best boolean, beats_baseline boolean, decision string, production_version int")  # fmt: skip


@register("ensemble_comparison")
def _ensembles(spark, sf_dir):
    """Blend, rank average and stacking of two candidates, with the gain gate."""
    train, val, test = _parts(spark, sf_dir)
    a, b = models.boosted_log().fit(train, val), models.boosted_raw().fit(train, val)

    def base(df):
        return materialise(b.predict(a.predict(df, "pred_a"), "pred_b").select(*KEYS, "trip_count", "pred_a", "pred_b"), "base")

    val_preds, test_preds = base(val), base(test)
    preds = ["pred_a", "pred_b"]
    best = min(evaluation.error_metrics(test_preds, pred=p).first().mape for p in preds)
    candidates = {
        "weighted_blend": test_preds.withColumn("prediction", ensembles.weighted_blend(preds)),
        "rank_average": ensembles.rank_average(test_preds, preds, KEYS),
        "stacking": ensembles.stack(val_preds, preds).predict(test_preds),
    }
    rows = []
    for name, df in candidates.items():
        mape = evaluation.error_metrics(df).first().mape
        rows.append({"strategy": name, "test_mape": mape, "gain": best - mape, "passes": evaluation.gain_passes(best, mape)})
    return _rows(spark, rows, "strategy string, test_mape double, gain double, passes boolean")


@register("feature_importance")
def _importance(spark, sf_dir):
    """Inputs by gain."""
    train, val, _ = _parts(spark, sf_dir)
    return models.boosted_log().fit(train, val).importances(spark)


@register("train_score_monitor")
def _cycle(spark, sf_dir):
    """One monthly cycle: train and register, promote, score, monitor; returns the monitoring row."""
    hourly = materialise(hourly_of(spark, sf_dir), "hourly")
    root = scratch_path(spark, "cycle")
    registry = ModelRegistry(spark, f"{root}/registry")
    result = forecast.train(spark, hourly, RUN_DATE, registry, models.boosted_log(), min_rows=_least_rows(hourly))
    registry.set_alias(forecast.MODEL_NAME, "production", result["version"])
    forecast.score(spark, hourly, RUN_DATE, registry, f"{root}/forecast", LOOKBACK)
    row = forecast.monitor(spark, hourly, RUN_DATE, registry, f"{root}/forecast", f"{root}/monitoring", LOOKBACK)
    return row.drop("_scored_at", "run_key")


@register("scored_month")
def _scored_month(spark, sf_dir):
    """Forecast table after two runs for the same month."""
    hourly = materialise(hourly_of(spark, sf_dir), "hourly")
    root = scratch_path(spark, "score")
    registry = ModelRegistry(spark, f"{root}/registry")
    train, val, _ = forecast.parts(forecast.training_matrix(hourly, RUN_DATE), RUN_DATE)
    version = registry.register(forecast.MODEL_NAME, models.ridge(1.0).fit(train, val), RUN_DATE, {})
    registry.set_alias(forecast.MODEL_NAME, "production", version)
    for _ in range(2):
        forecast.score(spark, hourly, RUN_DATE, registry, f"{root}/forecast", LOOKBACK)
    return tables.read_table(spark, f"{root}/forecast").drop("forecast_month")


@register("model_registry")
def _registry(spark, sf_dir):
    """Two registered versions, the first promoted."""
    train, val, test = _parts(spark, sf_dir)
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    for alpha in (1.0, 10.0):
        model = models.ridge(alpha).fit(train, val)
        registry.register("demand", model, RUN_DATE, {"test_mape": evaluation.error_metrics(model.predict(test)).first().mape})
    registry.set_alias("demand", "production", 1)
    return registry.versions().join(registry.aliases(), ["model_name", "version"], "left").select("model_name", "version", "alias", "model_type", F.col("metrics")["test_mape"].alias("test_mape"))
