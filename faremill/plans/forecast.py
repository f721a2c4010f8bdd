"""Train, score and monitor the demand forecast."""

from __future__ import annotations

import math
from dataclasses import asdict
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_text
from ..functions.numeric import round_half_even
from ..operators import evaluation, features, models, monitoring, splits
from ..operators.quality import require_matrix
from ..operators.registry import ModelRegistry
from ..schema import FEATURES
from ..session import materialise
from ..sources import tables

MODEL_NAME = "demand_forecast_hourly"
_BASELINE = "position int, feature string, mean double, std double"


def training_matrix(hourly: DataFrame, run_date: date, cache: str | None = None) -> DataFrame:
    """Complete feature rows of a run, saved once because every fit reads them again.

    A cache is kept by split dates and by the files of ``hourly``: after a reload of the same months it is built anew.
    """
    s = splits.rolling_splits(run_date)

    def build() -> DataFrame:
        return features.complete_rows(features.build_feature_matrix(hourly, s.train_start, s.test_end))

    if cache:
        return tables.cached(hourly.sparkSession, f"{cache}/{s.train_start}_{s.test_end}", build, tables.version_of(hourly))
    return materialise(build(), "matrix")


def parts(matrix: DataFrame, run_date: date, mode: str = "parity") -> tuple[DataFrame, DataFrame, DataFrame]:
    labelled = splits.assign_split(matrix, splits.rolling_splits(run_date), mode=mode)
    return tuple(labelled.filter(F.col("split") == p).drop("split") for p in ("train", "val", "test"))


def train(
    spark: SparkSession,
    hourly: DataFrame,
    run_date: date,
    registry: ModelRegistry,
    spec: models.ModelSpec | None = None,
    cache: str | None = None,
    min_rows: int = 10_000,
) -> dict:
    """Fit on the rolling split, record errors, baseline and drift reference, register as staging."""
    s = splits.rolling_splits(run_date)
    matrix = training_matrix(hourly, run_date, cache)
    require_matrix(matrix, s.train_end, s.val_start, min_rows=min_rows)
    tr, va, te = parts(matrix, run_date)
    model = (spec or models.boosted_log()).fit(tr, va)
    val = evaluation.error_metrics(model.predict(va)).first()
    test = evaluation.error_metrics(model.predict(te)).first()
    baseline = models.baseline_mape(te)
    metrics = {f"val_{k}": val[k] for k in ("mae", "rmse", "mape")} | {f"test_{k}": test[k] for k in ("mae", "rmse", "mape")}
    metrics |= {"baseline_mape": baseline, "mape_vs_baseline": baseline - test.mape}
    version = registry.register(MODEL_NAME, model, run_date, metrics)
    path = registry.resolve(MODEL_NAME, "staging").path
    features.feature_baseline(tr).write.mode("overwrite").parquet(f"{path}-baseline")
    return {"version": version, "beats_baseline": baseline - test.mape > 0, "splits": asdict(s)} | metrics


def walk_forward_errors(matrix: DataFrame, run_date: date, spec: models.ModelSpec) -> list[dict]:
    """Test error of a refit on every complete fold; a row per fold."""
    members = materialise(splits.walk_forward(matrix, run_date), "folds", partition_by="fold")
    out = []
    for (fold,) in sorted(evaluation.complete_folds(members).collect()):
        part = {s: members.filter((F.col("fold") == fold) & (F.col("split") == s)) for s in ("train", "val", "test")}
        model = spec.fit(part["train"], part["val"])
        out.append({"fold": int(fold), "mape": evaluation.error_metrics(model.predict(part["test"])).first().mape})
    return out


def promote(hourly: DataFrame, run_date: date, registry: ModelRegistry, trained: dict, spec: models.ModelSpec, cache: str | None = None) -> dict:
    """Decide on a version that ``train`` registered; only a promoted one becomes production.

    Gates: fold errors vary little, the test error beats the best known one and the naive baseline.
    Without a complete fold the deviation is unknown, and the version is held.
    """
    errors = [r["mape"] for r in walk_forward_errors(training_matrix(hourly, run_date, cache), run_date, spec)]
    mean = sum(errors) / len(errors) if errors else math.nan
    std = math.sqrt(sum((e - mean) ** 2 for e in errors) / len(errors)) if errors else math.nan
    gates = evaluation.promotion(std, trained["test_mape"], trained["baseline_mape"])
    if gates.decision == "PROMOTE":
        registry.set_alias(MODEL_NAME, "production", trained["version"])
    production = registry.aliases().filter((F.col("model_name") == MODEL_NAME) & (F.col("alias") == "production")).first()
    return {
        "version": trained["version"], "cv_mape_mean": mean, "cv_mape_std": std, "test_mape": trained["test_mape"],
        "baseline_mape": trained["baseline_mape"], **asdict(gates), "decision": gates.decision,
        "production_version": production.version if production else None,
    }


def month_rows(hourly: DataFrame, run_date: date, lookback_hours: int) -> DataFrame:
    """Complete feature rows of the run's month.

    Lags count rows, so a zone needs 168 rows inside the look-back before it is scored from
    the first hour on; a longer look-back helps where many zone-hours are empty.
    """
    first, last = splits.scoring_window(run_date)
    return features.complete_rows(features.build_feature_matrix(hourly, first, last, lookback_hours))


def score_rows(
    model: models.FittedModel, hourly: DataFrame, run_date: date, version: str, lookback_hours: int = features.WEEK_HOURS
) -> DataFrame:
    """Predictions for the run's month, rounded to two decimals."""
    rows = month_rows(hourly, run_date, lookback_hours)
    return model.predict(rows).select(
        "pickup_hour",
        "pu_location_id",
        "pickup_borough",
        round_half_even("prediction", 2).alias("predicted_trip_count"),
        F.lit(version).alias("model_version"),
        F.lit(run_date).alias("_run_date"),
    )


def score(
    spark: SparkSession,
    hourly: DataFrame,
    run_date: date,
    registry: ModelRegistry,
    forecast_path: str,
    lookback_hours: int = features.WEEK_HOURS,
) -> int:
    """Score with the production model and replace the month (and any earlier try of this run)."""
    model, version = registry.load(MODEL_NAME, "production")
    scored = score_rows(model, hourly, run_date, str(version), lookback_hours)
    rows = materialise(tables.conform(scored, tables.FORECAST_SCHEMA), "forecast")
    n = rows.count()
    if n == 0:
        raise ValueError(f"no feature rows for run {run_date}")
    tables.replace_run(spark, forecast_path, rows.withColumn("forecast_month", month_text("pickup_hour")), "_run_date", "forecast_month")
    return n


def monitor(
    spark: SparkSession,
    hourly: DataFrame,
    run_date: date,
    registry: ModelRegistry,
    forecast_path: str,
    monitoring_path: str,
    lookback_hours: int = features.WEEK_HOURS,
) -> DataFrame:
    """Compare the run's forecast with demand and replace its monitoring row.

    A version without a saved baseline is monitored without drift: no feature counts as drifted.
    """
    info = registry.resolve(MODEL_NAME, "production")
    first, last = splits.scoring_window(run_date)
    predictions = tables.read_table(spark, forecast_path)
    accuracy = monitoring.forecast_accuracy(predictions, hourly, run_date, first, last)
    current = month_rows(hourly, run_date, lookback_hours)
    saved = f"{info.path}-baseline"
    baseline = spark.read.schema(_BASELINE).parquet(saved) if tables.exists(spark, saved) else spark.createDataFrame([], _BASELINE)
    drift = monitoring.feature_drift(current, baseline, FEATURES)
    nan = float("nan")
    row = monitoring.monitoring_row(
        materialise(accuracy, "accuracy"), drift, run_date, first.strftime("%Y-%m"), str(info.version), info.run_id,
        info.metrics.get("test_mape", nan), info.metrics.get("baseline_mape", nan),
    )
    typed = tables.conform(row, tables.MONITORING_SCHEMA).withColumn("run_key", F.date_format("monitor_date", "yyyy-MM-dd"))
    tables.replace_partitions(materialise(typed, "monitoring"), monitoring_path, "run_key")
    return spark.read.parquet(monitoring_path).filter(F.col("monitor_date") == F.lit(run_date))
