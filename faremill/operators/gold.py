"""Hourly and daily revenue facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import HOUR_TEXT_FORMAT, hour_of, minutes_between, month_text
from ..functions.numeric import exact_joined_sql, exact_parts_sql, exact_sum_sql, half_up_sql, ratio_sql
from ..schema import TripRules


def revenue_trips(silver: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Trips that count as revenue; a NULL payment type is dropped as well."""
    return silver.filter(~F.col("payment_type").isin(*rules.excluded_payments))


def with_zone_labels(df: DataFrame, zones: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Left join to the zone dimension, ``Unknown`` where a zone id has no row.

    The fact rows are hourly sums by then. Spark broadcasts a dimension below its byte threshold;
    a larger one is shuffled, and adaptive execution splits a busy zone.
    """
    labels = zones.select(
        F.col("LocationID").alias("_zone_key"),
        F.col("Borough").alias("pickup_borough"),
        F.col("Zone").alias("pickup_zone"),
        "service_zone",
    )
    joined = df.join(labels, F.col("pu_location_id") == F.col("_zone_key"), "left").drop("_zone_key")
    missing = F.lit(rules.missing_label)
    return joined.withColumns(
        {c: F.coalesce(F.col(c), missing) for c in ("pickup_borough", "pickup_zone", "service_zone")}
    )


def _named(measures: dict[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in measures.items()]


def build_hourly(silver: DataFrame, zones: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """One row per hour, pickup zone and vendor.

    Measures are summed before the dimension join: the zone labels depend on the zone
    id alone, so the join handles aggregated rows instead of trips.
    """
    trips = revenue_trips(silver, rules).select(
        hour_of("tpep_pickup_datetime").alias("pickup_hour"),
        "pu_location_id",
        "vendor_id",
        "payment_type",
        "passenger_count",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "trip_distance",
        "cbd_congestion_fee",
        "airport_fee",
        minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("minutes"),
    )
    sums = trips.groupBy("pickup_hour", "pu_location_id", "vendor_id").agg(
        *_named(
            {
                "trip_count": "count(1)",
                "total_passengers": "sum(passenger_count)",
                "_passenger_rows": "count(passenger_count)",
                "_revenue": exact_sum_sql("total_amount"),
                "_fare": exact_sum_sql("fare_amount"),
                "_miles": exact_sum_sql("trip_distance"),
                "_mile_rows": "count(trip_distance)",
                "_minutes": "sum(minutes)",
                "_minute_rows": "count(minutes)",
                "_tip_pct": exact_sum_sql(_TIP_PCT, 6),
                "_tip_rows": f"count({_TIP_PCT})",
                "_card_trips": f"count_if(payment_type = {rules.card_payment})",
                "_congestion": exact_sum_sql("coalesce(cbd_congestion_fee, 0.0D)"),
                "_airport": exact_sum_sql("coalesce(airport_fee, 0.0D)"),
            }
        )
    )
    return _hourly_columns(sums, zones, rules)


def _hourly_columns(sums: DataFrame, zones: DataFrame, rules: TripRules) -> DataFrame:
    """Labels and ratios of summed hours."""
    labelled = with_zone_labels(sums, zones, rules)
    vendor_name = " ".join(f"WHEN {code} THEN '{label}'" for code, label in rules.vendor_labels.items())
    key = f"md5(concat(date_format(pickup_hour, '{HOUR_TEXT_FORMAT}'), '|', pu_location_id, '|', vendor_id))"
    columns = {
        "fct_id": key,
        "pickup_hour": "pickup_hour",
        "pickup_date": "to_date(pickup_hour)",
        "hour_of_day": "hour(pickup_hour)",
        "day_of_week": "dayname(pickup_hour)",
        "pu_location_id": "pu_location_id",
        "pickup_borough": "pickup_borough",
        "pickup_zone": "pickup_zone",
        "service_zone": "service_zone",
        "vendor_id": "vendor_id",
        "vendor_name": f"CASE vendor_id {vendor_name} ELSE '{rules.missing_label}' END",
        "trip_count": "trip_count",
        "total_passengers": "total_passengers",
        "avg_passengers_per_trip": half_up_sql(ratio_sql("total_passengers", "_passenger_rows"), 2),
        "total_revenue": half_up_sql("_revenue", 2),
        "total_fare": half_up_sql("_fare", 2),
        "revenue_per_trip": half_up_sql(ratio_sql("_revenue", "trip_count"), 2),
        "total_distance_miles": half_up_sql("_miles", 2),
        "avg_distance_miles": half_up_sql(ratio_sql("_miles", "_mile_rows"), 2),
        "revenue_per_mile": half_up_sql(ratio_sql("_revenue", "_miles"), 2),
        "avg_trip_duration_minutes": half_up_sql(ratio_sql("_minutes", "_minute_rows"), 1),
        "avg_tip_pct": half_up_sql(ratio_sql("_tip_pct", "_tip_rows"), 1),
        "credit_card_trip_pct": half_up_sql(ratio_sql("_card_trips * 100.0D", "trip_count"), 1),
        "total_congestion_fees": half_up_sql("_congestion", 2),
        "total_airport_fees": half_up_sql("_airport", 2),
    }
    return labelled.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


_TIP_PCT = "CASE WHEN tip_amount IS NOT NULL AND fare_amount > 0 THEN tip_amount / fare_amount * 100.0D END"
#: Values summed exactly, as high and low parts: SQL text and decimals.
_EXACT = {
    "_revenue": ("total_amount", 4),
    "_fare": ("fare_amount", 4),
    "_miles": ("trip_distance", 4),
    "_tip_pct": (_TIP_PCT, 6),
    "_congestion": ("coalesce(cbd_congestion_fee, 0.0D)", 4),
    "_airport": ("coalesce(airport_fee, 0.0D)", 4),
}
#: Values of which NULLs are counted apart, since an hour without any has no sum.
_ROWS = {"_passenger_rows": "passenger_count", "_mile_rows": "trip_distance", "_minute_rows": "minutes", "_tip_rows": _TIP_PCT, "_revenue_rows": "total_amount", "_fare_rows": "fare_amount"}
HOUR_KEYS = ("pickup_hour", "pu_location_id", "vendor_id")


def hourly_moments(trips: DataFrame, rules: TripRules = TripRules(), sign: str = "sign") -> DataFrame:
    """Whole-number sums per hour, pickup zone and vendor, from which the hourly fact is worked out.

    Each trip counts ``sign`` times, 1 or -1: the sums of several change sets add up to those of the trips that
    are left, in any order.
    """
    rows = revenue_trips(trips, rules).withColumns({"pickup_hour": hour_of("tpep_pickup_datetime"), "minutes": minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime")})
    sums = {"trip_count": f"sum({sign})", "total_passengers": f"sum({sign} * coalesce(passenger_count, 0))", "_minutes": f"sum({sign} * coalesce(minutes, 0))"}
    sums |= {name: f"sum(CASE WHEN ({x}) IS NULL THEN 0 ELSE {sign} END)" for name, x in _ROWS.items()}
    sums |= {"_card_trips": f"sum(CASE WHEN payment_type = {rules.card_payment} THEN {sign} ELSE 0 END)"}
    for name, (x, digits) in _EXACT.items():
        sums[f"{name}_high"], sums[f"{name}_low"] = exact_parts_sql(f"coalesce({x}, 0.0D)", digits, sign)
    return rows.groupBy(*HOUR_KEYS).agg(*_named({name: f"CAST({sql} AS BIGINT)" for name, sql in sums.items()}))


def hourly_from_moments(moments: DataFrame, zones: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """The hourly fact from the moments of any number of change sets; hours without a trip left are gone."""
    columns = [c for c in moments.columns if c not in HOUR_KEYS]
    total = moments.groupBy(*HOUR_KEYS).agg(*[F.sum(c).alias(c) for c in columns]).filter(F.col("trip_count") > 0)
    whole = {name: exact_joined_sql(f"{name}_high", f"{name}_low", digits) for name, (_, digits) in _EXACT.items()}
    known = {"total_passengers": "_passenger_rows", "_miles": "_mile_rows", "_minutes": "_minute_rows", "_revenue": "_revenue_rows", "_fare": "_fare_rows"}
    sums = {name: whole.get(name, name) for name in ("trip_count", "total_passengers", "_minutes", "_card_trips", *_ROWS, *_EXACT)}
    sums |= {name: f"CASE WHEN {rows} > 0 THEN {sums[name]} END" for name, rows in known.items()}
    return _hourly_columns(total.selectExpr(*HOUR_KEYS, *[f"{sql} AS {name}" for name, sql in sums.items()]), zones, rules)


# Trips paid by card in an hourly row, and the tip share weighted by them. Rows without a tip
# share are left out on both sides of the ratio.
CARD_TRIPS = "credit_card_trip_pct / 100.0D * trip_count"
TIP_SUM = exact_sum_sql(f"avg_tip_pct * ({CARD_TRIPS})", 6)
TIP_WEIGHT = exact_sum_sql(f"CASE WHEN avg_tip_pct IS NOT NULL THEN {CARD_TRIPS} END", 6)


def build_daily(hourly: DataFrame) -> DataFrame:
    """One row per day and pickup zone, rolled up from the rounded hourly rows.

    Averages are weighted by trips, the tip share by card trips.
    """
    labels = ["pickup_date", "day_of_week", "pu_location_id", "pickup_borough", "pickup_zone", "service_zone"]
    sums = hourly.groupBy(*labels).agg(
        *_named(
            {
                "_trips": "sum(trip_count)",
                "_passengers": "sum(total_passengers)",
                "_revenue": exact_sum_sql("total_revenue"),
                "_fare": exact_sum_sql("total_fare"),
                "_miles": exact_sum_sql("total_distance_miles"),
                "_minutes": exact_sum_sql("avg_trip_duration_minutes * trip_count"),
                "_tip": TIP_SUM,
                "_tip_weight": TIP_WEIGHT,
                "_card": exact_sum_sql("credit_card_trip_pct * trip_count"),
                "_congestion": exact_sum_sql("total_congestion_fees"),
                "_airport": exact_sum_sql("total_airport_fees"),
            }
        )
    )
    columns = {"fct_id": "md5(concat(date_format(pickup_date, 'yyyy-MM-dd'), '|', pu_location_id))"}
    columns |= {c: c for c in labels}
    columns |= {
        "trip_count": "_trips",
        "total_passengers": "_passengers",
        "avg_passengers_per_trip": half_up_sql(ratio_sql("_passengers", "_trips"), 2),
        "total_revenue": half_up_sql("_revenue", 2),
        "total_fare": half_up_sql("_fare", 2),
        "revenue_per_trip": half_up_sql(ratio_sql("_revenue", "_trips"), 2),
        "total_distance_miles": half_up_sql("_miles", 2),
        "avg_distance_miles": half_up_sql(ratio_sql("_miles", "_trips"), 2),
        "revenue_per_mile": half_up_sql(ratio_sql("_revenue", "_miles"), 2),
        "avg_trip_duration_minutes": half_up_sql(ratio_sql("_minutes", "_trips"), 1),
        "avg_tip_pct": half_up_sql(ratio_sql("_tip", "_tip_weight"), 1),
        "credit_card_trip_pct": half_up_sql(ratio_sql("_card", "_trips"), 1),
        "total_congestion_fees": half_up_sql("_congestion", 2),
        "total_airport_fees": half_up_sql("_airport", 2),
    }
    return sums.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def orphan_zones(fact: DataFrame, zones: DataFrame, key: str = "pu_location_id") -> DataFrame:
    """Fact keys without a dimension row, with the number of fact rows each holds.

    Grouping first leaves one row per key for the anti join.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return per_key.join(zones.select(F.col("LocationID").alias(key)), key, "left_anti")


def with_month(df: DataFrame, time: str, name: str = "pickup_month") -> DataFrame:
    """Add the text month used as the storage partition of silver and gold tables."""
    return df.withColumn(name, month_text(time))
