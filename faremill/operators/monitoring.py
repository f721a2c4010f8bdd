"""Forecast monitoring: accuracy, degradation and feature drift."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import next_day, ntz_literal
from ..schema import FEATURES, PanelSpec
from .evaluation import mae, mape, rmse

# Tolerated growth of the error, drift limit in standard deviations.
DEGRADATION_FACTOR = 1.2
DRIFT_SIGMA = 2.0


def actual_demand(hourly: DataFrame, first: date, last: date, spec: PanelSpec = PanelSpec()) -> DataFrame:
    in_month = (F.col(spec.time) >= ntz_literal(first)) & (F.col(spec.time) < ntz_literal(next_day(last)))
    return hourly.filter(in_month).groupBy(spec.time, spec.key).agg(F.sum(spec.target).alias(spec.target))


def forecast_accuracy(
    predictions: DataFrame, hourly: DataFrame, run_date: date, first: date, last: date, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Errors of one run against the month's demand, with both row counts.

    A left join from the predictions keeps the unmatched ones for the count; the error
    aggregates skip them, which equals an inner join.
    """
    mine = predictions.filter(F.col("_run_date") == F.lit(run_date)).select(spec.time, spec.key, "predicted_trip_count")
    joined = mine.join(actual_demand(hourly, first, last, spec), [spec.time, spec.key], "left")
    y, p = F.col(spec.target).cast("double"), F.col("predicted_trip_count")
    matched = F.when(F.col(spec.target).isNotNull(), p)
    return joined.agg(
        mae(y, matched).alias("mae"),
        rmse(y, matched).alias("rmse"),
        mape(y, matched).alias("mape"),
        F.count(F.lit(1)).alias("n_predictions"),
        F.count(spec.target).alias("n_actuals"),
    )


def degraded(current: Column, training: Column, baseline: Column, factor: float = DEGRADATION_FACTOR) -> Column:
    """True if the error grew past the training error or past the naive baseline.

    A NaN or NULL reference value takes no part; NaN would otherwise compare as largest.
    """

    def beyond(reference: Column, times: float) -> Column:
        usable = reference.isNotNull() & ~F.isnan(reference)
        return usable & ~F.isnan(current) & (current > reference * times)

    return F.coalesce(beyond(training, factor), F.lit(False)) | F.coalesce(beyond(baseline, 1.0), F.lit(False))


def feature_drift(current: DataFrame, baseline: DataFrame, features: Sequence[str] = FEATURES, sigma: float = DRIFT_SIGMA) -> DataFrame:
    """Per feature: current mean against the training mean and deviation.

    Features without a baseline or without variation are skipped; the limit itself is
    not drift.
    """
    usable = [c for c in features if c in current.columns]
    means = current.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in usable])
    order = F.array_position(F.array(*[F.lit(c) for c in usable]), F.col("feature"))
    now = means.unpivot([], usable, "feature", "current_mean").withColumn("position", order)
    ref = baseline.select("feature", F.col("mean").alias("base_mean"), F.col("std").alias("base_std"))
    both = now.join(ref, "feature").filter((F.col("base_std") != 0) & ~F.isnan("base_std"))
    return both.withColumn(
        "drifted", F.abs(F.col("current_mean") - F.col("base_mean")) > F.col("base_std") * sigma
    )


def drift_summary(drift: DataFrame) -> DataFrame:
    """Drifted features in feature order as comma-separated text, and their number."""
    hits = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct("position", "feature"))))
    return drift.agg(
        F.array_join(F.transform(hits, lambda h: h["feature"]), ",").alias("drifted_features"),
        F.count_if("drifted").alias("n_drifted_features"),
    )


def monitoring_row(
    accuracy: DataFrame,
    drift: DataFrame,
    run_date: date,
    month: str,
    version: str,
    run_id: str,
    training_test_mape: float,
    baseline_mape: float,
) -> DataFrame:
    """The summary row of one run; raises when predictions or actuals are missing."""
    counts = accuracy.select("n_predictions", "n_actuals").first()
    if counts.n_predictions == 0:
        raise ValueError(f"no predictions for run {run_date}")
    if counts.n_actuals == 0:
        raise ValueError(f"no demand rows for {month}")
    row = accuracy.crossJoin(drift_summary(drift))  # both sides are single-row aggregates
    return row.select(
        F.lit(run_date).alias("monitor_date"),
        F.lit(month).alias("prediction_month"),
        F.lit(version).alias("model_version"),
        F.lit(run_id).alias("model_run_id"),
        "mae",
        "rmse",
        "mape",
        F.lit(training_test_mape).alias("training_test_mape"),
        F.lit(baseline_mape).alias("baseline_mape"),
        degraded(F.col("mape"), F.lit(training_test_mape), F.lit(baseline_mape)).alias("mape_degraded"),
        "n_predictions",
        "n_actuals",
        "drifted_features",
        "n_drifted_features",
        F.current_timestamp().cast("timestamp_ntz").alias("_scored_at"),
    )
