"""Forecast errors, naive baselines, error segments and promotion gates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col_of
from ..schema import TARGET, without

# Promotion and gain limits, in MAPE points.
CV_STD_LIMIT = 2.0
BEST_KNOWN_TEST_MAPE = 35.22
ENSEMBLE_GAIN = 0.5
SEARCH_GAIN = 0.5
WORST_SEGMENTS = 20
CHART_ROWS = 500

# Names of the ablation variants, each with the families it leaves out.
_ABLATED = {
    "full": (),
    "no_lag": ("lag", "fee", "rolling"),
    "no_rolling": ("rolling",),
    "no_congestion": ("fee",),
    "no_borough_enc": ("borough",),
    "calendar_only": ("lag", "fee", "rolling", "borough"),
}
ABLATION_SETS: dict[str, tuple[str, ...]] = {name: without(*families) for name, families in _ABLATED.items()}


def mae(y: Column, pred: Column) -> Column:
    return F.avg(F.abs(y - pred))


def rmse(y: Column, pred: Column) -> Column:
    return F.sqrt(F.avg((y - pred) * (y - pred)))


def mape(y: Column, pred: Column) -> Column:
    """Mean absolute percentage error over rows with a positive target; NaN without any."""
    share = F.when(y > 0, F.abs((y - pred) / y))
    return F.coalesce(F.avg(share) * 100, F.lit(math.nan))


def error_metrics(df: DataFrame, target: str | Column = TARGET, pred: str | Column = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, MAPE and row count from one aggregate, per group if asked."""
    y, p = col_of(target).cast("double"), col_of(pred).cast("double")
    aggs = [mae(y, p).alias("mae"), rmse(y, p).alias("rmse"), mape(y, p).alias("mape"), F.count(F.lit(1)).alias("n_rows")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def segment_errors(df: DataFrame, group: str, target: str = TARGET, pred: str = "prediction") -> DataFrame:
    """MAPE per group; ``n_rows`` counts all rows, also those MAPE leaves out."""
    y, p = F.col(target).cast("double"), F.col(pred).cast("double")
    return df.groupBy(group).agg(mape(y, p).alias("mape"), F.count(F.lit(1)).alias("n_rows"))


def worst_segments(segments: DataFrame, group: str, top: int = WORST_SEGMENTS) -> DataFrame:
    """The ``top`` groups by error (the report is a top-k); each task keeps only its own top."""
    return segments.orderBy(F.col("mape").desc(), F.col(group).asc()).limit(top)


def naive_week_lag(df: DataFrame) -> DataFrame:
    """Prediction = the value 168 rows back; rows without one are left out."""
    return df.withColumn("prediction", F.col("lag_168h_trip_count")).filter(F.col("prediction").isNotNull())


def seasonal_naive(df: DataFrame, lags: Sequence[str] = ("lag_1h_trip_count", "lag_24h_trip_count", "lag_168h_trip_count")) -> DataFrame:
    """Prediction = mean of the lag columns that are filled."""
    filled = [F.col(c).isNotNull().cast("int") for c in lags]
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in lags[1:]), F.coalesce(F.col(lags[0]), F.lit(0.0)))
    count = sum(filled[1:], filled[0])
    return df.withColumn("prediction", F.try_divide(total, count)).filter(F.col("prediction").isNotNull())


def baseline_gain(metrics: DataFrame, test: str = "test_mape", baseline: str = "baseline_mape") -> DataFrame:
    """Points gained over the naive baseline and whether the model beats it."""
    gain = F.col(baseline) - F.col(test)
    return metrics.withColumns({"mape_vs_baseline": gain, "beats_baseline": F.coalesce((gain > 0) & ~F.isnan(gain), F.lit(False))})


def fold_summary(fold_mapes: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold errors; NaN when every fold is empty."""
    nan = F.lit(math.nan)
    return fold_mapes.agg(
        F.coalesce(F.avg("mape"), nan).alias("mape_mean"),
        F.coalesce(F.stddev_pop("mape"), nan).alias("mape_std"),
        F.count(F.lit(1)).alias("n_folds"),
    )


def complete_folds(members: DataFrame) -> DataFrame:
    """Numbers of the folds whose train, validation and test parts all hold rows."""
    parts = members.groupBy("fold").agg(F.count_distinct("split").alias("parts"))
    return parts.filter(F.col("parts") == 3).select("fold")


def walk_forward_naive(members: DataFrame) -> DataFrame:
    """Fold errors of the week-lag forecast, which needs no fit.

    One aggregate yields the fold's error and tells which folds lack a part.
    """
    y, p = F.col(TARGET).cast("double"), F.col("lag_168h_trip_count")
    is_test = (F.col("split") == "test") & p.isNotNull()
    per_fold = members.groupBy("fold").agg(
        F.count_distinct("split").alias("_parts"),
        F.coalesce(F.avg(F.when(is_test & (y > 0), F.abs((y - p) / y))) * 100, F.lit(math.nan)).alias("mape"),
        F.count_if(is_test).alias("n_rows"),
    )
    return per_fold.filter(F.col("_parts") == 3).drop("_parts")


def residuals(df: DataFrame, keys: Sequence[str], target: str = TARGET, pred: str = "prediction") -> DataFrame:
    y, p = F.col(target).cast("double"), F.col(pred).cast("double")
    return df.select(*keys, y.alias("actual"), p.alias("predicted"), (y - p).alias("residual"))


def chart_rows(df: DataFrame, order: Sequence[str], n: int = CHART_ROWS) -> DataFrame:
    """First ``n`` rows in key order, the input of the line chart."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones whatever the partitioning: the first by MD5 of seed and keys."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(order, *keys).limit(n)


@dataclass(frozen=True)
class Promotion:
    stable: bool
    beats_best: bool
    beats_baseline: bool

    @property
    def decision(self) -> str:
        return "PROMOTE" if self.stable and self.beats_best and self.beats_baseline else "HOLD"


def promotion(cv_std: float, test_mape: float, baseline_mape: float, std_limit: float = CV_STD_LIMIT, best: float = BEST_KNOWN_TEST_MAPE) -> Promotion:
    """Gates before a model may be promoted; NaN fails a gate."""
    return Promotion(cv_std < std_limit, test_mape < best, baseline_mape - test_mape > 0)


def gain_passes(best_single: float, candidate: float, needed: float = ENSEMBLE_GAIN) -> bool:
    """Whether a candidate beats the best single model by more than ``needed`` points."""
    return best_single - candidate > needed
