"""Dashboard queries over the daily and hourly facts.

Rates shown for a group are ratios of sums, not means of rates: revenue per mile is
revenue over miles, tip share is weighted by card trips as in the daily fact.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum, exact_sum_sql, half_up_sql, ratio_sql, round_half_up, safe_ratio
from ..schema import PolicySpec
from .gold import TIP_SUM, TIP_WEIGHT

# Fixed value: first day counted by the congestion-fee figure.
FEES_FROM = date(2025, 1, 1)


def _expr(sql: str, digits: int = 2) -> Column:
    return F.expr(half_up_sql(sql, digits))


def _tip_pct() -> Column:
    return _expr(ratio_sql(TIP_SUM, TIP_WEIGHT))


def _revenue() -> Column:
    return _expr(exact_sum_sql("total_revenue"))


def _per_trip() -> Column:
    return _expr(ratio_sql(exact_sum_sql("total_revenue"), "sum(trip_count)"))


def _per_mile() -> Column:
    return _expr(ratio_sql(exact_sum_sql("total_revenue"), exact_sum_sql("total_distance_miles")))


def kpis(daily: DataFrame) -> DataFrame:
    return daily.agg(
        _revenue().alias("total_revenue"),
        F.sum("trip_count").alias("trip_count"),
        _per_trip().alias("revenue_per_trip"),
        _tip_pct().alias("avg_tip_pct"),
    )


def congestion_fees(daily: DataFrame, since: date = FEES_FROM) -> DataFrame:
    return daily.filter(F.col("pickup_date") >= F.lit(since)).agg(
        round_half_up(exact_sum("total_congestion_fees"), 2).alias("total_congestion_fees")
    )


def monthly_trend(daily: DataFrame) -> DataFrame:
    month = F.trunc("pickup_date", "month").alias("month_start")
    return daily.groupBy(month).agg(_revenue().alias("total_revenue"), F.sum("trip_count").alias("trip_count"))


def revenue_share(daily: DataFrame, group: str = "pickup_borough") -> DataFrame:
    """Revenue per group and its share of the total (a scalar subquery over the groups)."""
    grouped = daily.groupBy(group).agg(exact_sum("total_revenue").alias("_r"))
    overall = grouped.agg(exact_sum("_r")).scalar()
    return grouped.select(
        group,
        round_half_up("_r", 2).alias("total_revenue"),
        round_half_up(safe_ratio("_r", overall) * 100, 4).alias("revenue_share_pct"),
    )


def revenue_by_vendor(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("vendor_name").agg(_revenue().alias("total_revenue"))


def revenue_heatmap(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("day_of_week", "hour_of_day").agg(_revenue().alias("total_revenue"))


def vendor_efficiency(hourly: DataFrame) -> DataFrame:
    minutes = exact_sum_sql("avg_trip_duration_minutes * trip_count")
    return hourly.groupBy("vendor_name").agg(
        _per_trip().alias("avg_revenue_per_trip"), _expr(ratio_sql(minutes, "sum(trip_count)")).alias("avg_trip_duration")
    )


def zone_hierarchy(daily: DataFrame) -> DataFrame:
    """Service zone and borough totals with subtotals; ``level`` 0 is the finest, 3 the total."""
    return daily.rollup("service_zone", "pickup_borough").agg(
        F.grouping_id().cast("bigint").alias("level"),
        _revenue().alias("total_revenue"),
        F.sum("trip_count").alias("trip_count"),
    )


def policy_series(daily: DataFrame, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Trips and fees per day, flagged from the policy date on."""
    return daily.groupBy(spec.day).agg(
        F.sum("trip_count").alias("total_trip_count"),
        round_half_up(exact_sum("total_congestion_fees"), 2).alias("total_congestion_fees"),
    ).withColumn("is_post", F.col(spec.day) >= F.lit(spec.effective))


def borough_efficiency(daily: DataFrame) -> DataFrame:
    return daily.groupBy("pickup_borough").agg(_per_mile().alias("avg_revenue_per_mile"), _tip_pct().alias("tip_pct"))


def zone_density(daily: DataFrame) -> DataFrame:
    """Per zone id; zone names repeat, so the name is a label and not a key."""
    return daily.groupBy("pu_location_id", "pickup_zone").agg(
        F.sum("trip_count").alias("total_trip_count"), _per_mile().alias("avg_revenue_per_mile"), _tip_pct().alias("tip_pct")
    )


def latest_pre_post(summary: DataFrame) -> DataFrame:
    """Pre and post trips per borough of the newest run, largest pre value first."""
    newest = summary.filter(F.col("run_date") == summary.agg(F.max("run_date")).scalar())
    wide = newest.groupBy("run_date", "borough").pivot("period", ["pre", "post"]).agg(exact_sum("total_avg_daily_trips"))
    return wide.orderBy(F.col("pre").desc_nulls_last(), "borough")


def model_fit_table(series: DataFrame) -> DataFrame:
    return series.select(
        "run_date", "beta_trip_count", "p_value_trip_count", "r2_trip_count", "beta_revenue", "p_value_revenue", "r2_revenue"
    ).orderBy(F.col("run_date").desc())
