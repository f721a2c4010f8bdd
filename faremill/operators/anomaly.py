"""Zone-days that stand out against their own recent past."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import day_number
from .windows import series_window

# Baseline length in calendar days and the (one-sided) limit.
BASELINE_DAYS = 30
Z_LIMIT = 3.0


def rolling_baseline(daily: DataFrame, key: str = "pu_location_id", day: str = "pickup_date") -> DataFrame:
    """Mean and sample deviation over the 30 calendar days before each day.

    (key, day) is unique, so a series has one row per calendar day at most; both measures
    share one shuffle and one sort.
    """
    frame = series_window([key], "_day").rangeBetween(-BASELINE_DAYS, -1)
    out = daily.withColumn("_day", day_number(day))
    return out.withColumns(
        {
            f"{m}_{name}": fn(F.col(m).cast("double")).over(frame)
            for m in ("trip_count", "total_revenue")
            for name, fn in (("mean", F.avg), ("std", F.stddev_samp))
        }
    ).drop("_day")


def score_days(daily: DataFrame, key: str = "pu_location_id", day: str = "pickup_date") -> DataFrame:
    """z-scores per zone-day; NULL without two earlier days or without variation."""
    base = rolling_baseline(daily, key, day)

    def z(m: str):
        spread = F.col(f"{m}_std")
        return F.when(spread > 0, (F.col(m) - F.col(f"{m}_mean")) / spread)

    return base.select(
        F.col(day).alias("anomaly_date"),
        key,
        "pickup_borough",
        "trip_count",
        z("trip_count").alias("z_score"),
        z("total_revenue").alias("revenue_z_score"),
    ).withColumn("is_anomaly", F.coalesce(F.col("z_score") > Z_LIMIT, F.lit(False)))
