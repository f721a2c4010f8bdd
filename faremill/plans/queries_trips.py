"""Queries over the trip layers: cleaning, facts, tests and dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar
from ..functions.numeric import exact_sum
from ..operators import features, gold, marts, quality, silver
from ..schema import PolicySpec
from . import inputs, oracle
from .catalog import DT, TS, daily_of, hourly_of, register, rounded, silver_of, typed
from .oracle import half_up, ratio, total


def _hourly_columns() -> str:
    return (
        f"* REPLACE ({TS.format('pickup_hour')}, {DT.format('pickup_date')}, CAST(hour_of_day AS BIGINT) AS hour_of_day,"
        " CAST(pu_location_id AS BIGINT) AS pu_location_id, CAST(vendor_id AS BIGINT) AS vendor_id)"
    )


# --------------------------------------------------------------------------- silver and gold
@register("silver_trips", oracle.sql(
    "SELECT trip_id, CAST(vendor_id AS BIGINT) vendor_id, CAST(rate_code_id AS BIGINT) rate_code_id,"
    " CAST(pu_location_id AS BIGINT) pu_location_id, CAST(do_location_id AS BIGINT) do_location_id,"
    f" {TS.format('tpep_pickup_datetime')}, {TS.format('tpep_dropoff_datetime')},"
    " CAST(passenger_count AS BIGINT) passenger_count, trip_distance, store_and_fwd_flag,"
    " CAST(payment_type AS BIGINT) payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,"
    " improvement_surcharge, congestion_surcharge, airport_fee, cbd_congestion_fee, total_amount,"
    " 'trips_' || _batch_id || '.parquet' AS _source_file,"
    " strftime(TIMESTAMP '2025-07-01 00:00:00' + INTERVAL 1 DAY * ing, '%Y-%m-%d %H:%M:%S') AS _ingested_at, _batch_id"
    " FROM silver", "silver"))
def _silver_trips(spark, sf_dir):
    """Typed, de-duplicated, filtered trips."""
    return silver_of(spark, sf_dir)


@register("bad_row_report", oracle.sql(
    "SELECT rows_checked, rule, rejected_rows FROM (SELECT count(*) AS rows_checked,"
    " count(*) FILTER (WHERE NOT COALESCE(passenger_count > 0, false)) AS passenger_count_positive,"
    " count(*) FILTER (WHERE NOT COALESCE(trip_distance > 0, false)) AS trip_distance_positive,"
    " count(*) FILTER (WHERE NOT COALESCE(fare_amount > 0, false)) AS fare_amount_positive,"
    " count(*) FILTER (WHERE NOT COALESCE(tpep_dropoff_datetime > tpep_pickup_datetime, false)) AS dropoff_after_pickup,"
    " count(*) FILTER (WHERE NOT COALESCE(rate_code_id <> 99, false)) AS rate_code_known,"
    " count(*) FILTER (WHERE NOT COALESCE(year(tpep_pickup_datetime) BETWEEN 2015 AND 2030, false)) AS pickup_year_plausible,"
    " count(*) FILTER (WHERE NOT COALESCE(strftime(tpep_pickup_datetime,'%Y-%m') = _batch_id, false)) AS pickup_in_batch_month,"
    " count(*) - (SELECT count(*) FROM silver) AS any_rule FROM latest)"
    " UNPIVOT (rejected_rows FOR rule IN (passenger_count_positive, trip_distance_positive, fare_amount_positive,"
    " dropoff_after_pickup, rate_code_known, pickup_year_plausible, pickup_in_batch_month, any_rule))", "silver"))
def _bad_rows(spark, sf_dir):
    return silver.bad_row_report(typed(spark, sf_dir))


@register("gold_hourly", oracle.sql(f"SELECT {_hourly_columns()} FROM hourly", "hourly"))
def _gold_hourly(spark, sf_dir):
    return hourly_of(spark, sf_dir)


@register("gold_daily", oracle.sql(
    f"SELECT * REPLACE ({DT.format('pickup_date')}, CAST(pu_location_id AS BIGINT) AS pu_location_id) FROM daily", "daily"))
def _gold_daily(spark, sf_dir):
    return daily_of(spark, sf_dir)


@register("latest_delivery", oracle.sql(
    "SELECT CAST(vendor_id AS BIGINT) vendor_id, count(*) AS rows_kept, count(*) FILTER (WHERE ing = 1) AS redelivered_kept,"
    f" {half_up(total('total_amount'), 2)} AS total_amount FROM latest GROUP BY vendor_id", "latest"))
def _latest(spark, sf_dir):
    """Keep-latest de-duplication before any filter."""
    rules = silver.TripRules()
    kept = silver.latest_by_key(typed(spark, sf_dir), rules.dedup_keys, "_ingested_at", rules.dedup_tiebreak)
    second = F.col("_ingested_at") > F.lit("2025-07-01 00:00:00").cast("timestamp_ntz")
    return rounded(
        kept.groupBy("vendor_id").agg(
            F.count(F.lit(1)).alias("rows_kept"),
            F.count_if(second).alias("redelivered_kept"),
            exact_sum("total_amount").alias("total_amount"),
        ),
        ["total_amount"], 2)


@register("trip_minutes", oracle.sql(
    "SELECT CAST(date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS BIGINT) AS minutes, count(*) AS trips"
    " FROM silver GROUP BY 1", "silver"))
def _trip_minutes(spark, sf_dir):
    """Distribution of trip length in minute boundaries."""
    minutes = calendar.minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("minutes")
    return silver_of(spark, sf_dir).groupBy(minutes).agg(F.count(F.lit(1)).alias("trips"))


@register("revenue_trips_by_payment", oracle.sql(
    "SELECT CAST(payment_type AS BIGINT) payment_type, count(*) AS trips, count(tip_amount) AS trips_with_tip"
    " FROM silver WHERE payment_type NOT IN (3,4,6) GROUP BY payment_type", "silver"))
def _payments(spark, sf_dir):
    """Payment exclusion and the card-only tip."""
    return gold.revenue_trips(silver_of(spark, sf_dir)).groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("trips"), F.count("tip_amount").alias("trips_with_tip"))


@register("event_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events")
def _event_fields(spark, sf_dir):
    """Typed path extraction from a JSON text column through a variant."""
    v = F.parse_json("props")
    return inputs.table(spark, sf_dir, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), "event_type")


@register("epoch_round_trip", f"SELECT event_id, epoch_us(ts) AS micros, {TS.format('ts')} FROM events")
def _epoch(spark, sf_dir):
    """Zone-free timestamps to epoch microseconds and back."""
    micros = calendar.epoch_micros("ts")
    return inputs.table(spark, sf_dir, "events").select("event_id", micros.alias("micros"), calendar.micros_to_ntz(micros).alias("ts"))


@register("calendar_parts", "SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS event_hour,"
    " strftime(ts, '%Y-%m-%d') AS event_date, CAST(hour(ts) AS BIGINT) AS hour_of_day, strftime(ts, '%a') AS day_name,"
    " CAST(isodow(ts) - 1 AS BIGINT) AS weekday, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_start,"
    " strftime(ts, '%Y-%m') AS month_text FROM events")
def _calendar(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", calendar.hour_of("ts").alias("event_hour"), F.to_date("ts").alias("event_date"), F.hour("ts").alias("hour_of_day"),
        F.dayname("ts").alias("day_name"), calendar.weekday_monday0("ts").alias("weekday"),
        F.trunc("ts", "month").alias("month_start"), calendar.month_text("ts").alias("month_text"))


@register("orphan_zones", oracle.sql(
    "SELECT CAST(pu_location_id AS BIGINT) pu_location_id, count(*) AS fact_rows FROM silver"
    " WHERE pu_location_id NOT IN (SELECT LocationID FROM zones) GROUP BY 1", "silver", "zones"))
def _orphans(spark, sf_dir):
    return gold.orphan_zones(silver_of(spark, sf_dir), inputs.zones(spark, sf_dir))


@register("borough_codes", oracle.sql(
    "SELECT pickup_borough, CAST(CASE pickup_borough WHEN 'Manhattan' THEN 0 WHEN 'Brooklyn' THEN 1 WHEN 'Queens' THEN 2"
    " WHEN 'Bronx' THEN 3 WHEN 'Staten Island' THEN 4 WHEN 'EWR' THEN 5 ELSE 6 END AS BIGINT) AS borough_code,"
    " CAST(sum(trip_count) AS BIGINT) AS trip_count FROM daily GROUP BY 1, 2", "daily"))
def _borough_codes(spark, sf_dir):
    return daily_of(spark, sf_dir).groupBy("pickup_borough", features.borough_code("pickup_borough").alias("borough_code")).agg(
        F.sum("trip_count").alias("trip_count"))


def _test_sql(table: str, key: str, columns) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM t"
        for c in columns
    ]
    parts.append(
        f"SELECT '{table}', '{key}', 'unique', count(*) FROM (SELECT {key} FROM t WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
    )
    return " UNION ALL ".join(parts)


_SILVER_T = (
    ", t AS (SELECT *, 'trips_' || _batch_id || '.parquet' AS _source_file,"
    " TIMESTAMP '2025-07-01 00:00:00' + INTERVAL 1 DAY * ing AS _ingested_at FROM silver) "
)


@register("silver_tests", oracle.sql(_SILVER_T + _test_sql("silver", "trip_id", quality.SILVER_NOT_NULL), "silver"))
def _silver_tests(spark, sf_dir):
    return quality.table_tests(silver_of(spark, sf_dir), "silver", "trip_id", quality.SILVER_NOT_NULL)


@register("hourly_tests", oracle.sql(
    ", t AS (SELECT * FROM hourly) " + _test_sql("hourly", "fct_id", quality.HOURLY_NOT_NULL), "hourly"))
def _hourly_tests(spark, sf_dir):
    return quality.table_tests(hourly_of(spark, sf_dir), "hourly", "fct_id", quality.HOURLY_NOT_NULL)


@register("daily_tests", oracle.sql(
    ", t AS (SELECT * FROM daily) " + _test_sql("daily", "fct_id", quality.DAILY_NOT_NULL), "daily"))
def _daily_tests(spark, sf_dir):
    return quality.table_tests(daily_of(spark, sf_dir), "daily", "fct_id", quality.DAILY_NOT_NULL)


# --------------------------------------------------------------------------- dashboards
_CARD = "credit_card_trip_pct/100.0E0*trip_count"
_TIP = half_up(ratio(total(f"avg_tip_pct*({_CARD})", 6), total(f"CASE WHEN avg_tip_pct IS NOT NULL THEN {_CARD} END", 6)), 2)
_REV = half_up(total("total_revenue"), 2)
_PER_TRIP = half_up(ratio(total("total_revenue"), "sum(trip_count)"), 2)
_PER_MILE = half_up(ratio(total("total_revenue"), total("total_distance_miles")), 2)
_TRIPS = "CAST(sum(trip_count) AS BIGINT)"


@register("kpis", oracle.sql(
    f"SELECT {_REV} AS total_revenue, {_TRIPS} AS trip_count, {_PER_TRIP} AS revenue_per_trip, {_TIP} AS avg_tip_pct FROM daily", "daily"))
def _kpis(spark, sf_dir):
    return marts.kpis(daily_of(spark, sf_dir))


@register("congestion_fees", oracle.sql(
    f"SELECT {half_up(total('total_congestion_fees'), 2)} AS total_congestion_fees FROM daily WHERE pickup_date >= DATE '2025-01-01'", "daily"))
def _fees(spark, sf_dir):
    return marts.congestion_fees(daily_of(spark, sf_dir))


@register("monthly_trend", oracle.sql(
    f"SELECT strftime(date_trunc('month', pickup_date), '%Y-%m-%d') AS month_start, {_REV} AS total_revenue, {_TRIPS} AS trip_count"
    " FROM daily GROUP BY 1", "daily"))
def _trend(spark, sf_dir):
    return marts.monthly_trend(daily_of(spark, sf_dir))


@register("revenue_share_by_borough", oracle.sql(
    f", g AS (SELECT pickup_borough, {total('total_revenue')} AS r FROM daily GROUP BY 1)"
    f" SELECT pickup_borough, {half_up('r', 2)} AS total_revenue,"
    f" {half_up('r/(SELECT ' + total('r') + ' FROM g)*100', 4)} AS revenue_share_pct FROM g", "daily"))
def _share(spark, sf_dir):
    return marts.revenue_share(daily_of(spark, sf_dir))


@register("revenue_by_vendor", oracle.sql(f"SELECT vendor_name, {_REV} AS total_revenue FROM hourly GROUP BY 1", "hourly"))
def _by_vendor(spark, sf_dir):
    return marts.revenue_by_vendor(hourly_of(spark, sf_dir))


@register("revenue_heatmap", oracle.sql(
    f"SELECT day_of_week, CAST(hour_of_day AS BIGINT) AS hour_of_day, {_REV} AS total_revenue FROM hourly GROUP BY 1, 2", "hourly"))
def _heatmap(spark, sf_dir):
    return marts.revenue_heatmap(hourly_of(spark, sf_dir))


@register("vendor_efficiency", oracle.sql(
    f"SELECT vendor_name, {_PER_TRIP} AS avg_revenue_per_trip,"
    f" {half_up(ratio(total('avg_trip_duration_minutes*trip_count'), 'sum(trip_count)'), 2)} AS avg_trip_duration FROM hourly GROUP BY 1", "hourly"))
def _vendor_efficiency(spark, sf_dir):
    return marts.vendor_efficiency(hourly_of(spark, sf_dir))


@register("zone_hierarchy", oracle.sql(
    "SELECT service_zone, pickup_borough, CAST(grouping(service_zone)*2 + grouping(pickup_borough) AS BIGINT) AS level,"
    f" {_REV} AS total_revenue, {_TRIPS} AS trip_count FROM daily GROUP BY ROLLUP (service_zone, pickup_borough)", "daily"))
def _hierarchy(spark, sf_dir):
    return marts.zone_hierarchy(daily_of(spark, sf_dir))


@register("policy_series", oracle.sql(
    f"SELECT {DT.format('pickup_date')}, {_TRIPS} AS total_trip_count, {half_up(total('total_congestion_fees'), 2)} AS total_congestion_fees,"
    f" pickup_date >= DATE '{PolicySpec().effective}' AS is_post FROM daily GROUP BY daily.pickup_date", "daily"))
def _policy_series(spark, sf_dir):
    return marts.policy_series(daily_of(spark, sf_dir))


@register("borough_efficiency", oracle.sql(
    f"SELECT pickup_borough, {_PER_MILE} AS avg_revenue_per_mile, {_TIP} AS tip_pct FROM daily GROUP BY 1", "daily"))
def _borough_efficiency(spark, sf_dir):
    return marts.borough_efficiency(daily_of(spark, sf_dir))


@register("zone_density", oracle.sql(
    f"SELECT CAST(pu_location_id AS BIGINT) AS pu_location_id, pickup_zone, {_TRIPS} AS total_trip_count,"
    f" {_PER_MILE} AS avg_revenue_per_mile, {_TIP} AS tip_pct FROM daily GROUP BY pu_location_id, pickup_zone", "daily"))
def _zone_density(spark, sf_dir):
    return marts.zone_density(daily_of(spark, sf_dir))
