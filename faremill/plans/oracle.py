"""Independent SQL for the result checks, written for DuckDB.

Each block is a named common table expression; ``sql(final, *needs)`` puts the blocks
a query needs in front of it. Nothing here is executed by the engine.
"""

from __future__ import annotations


def half_up(x: str, digits: int) -> str:
    s = f"{10**digits}E0"
    return f"(CASE WHEN ({x}) < 0 THEN 0-floor(0-({x})*{s}+0.5E0) ELSE floor(({x})*{s}+0.5E0) END/{s})"


def total(x: str, digits: int = 4) -> str:
    s = f"{10**digits}E0"
    return f"(CAST(sum(CAST(floor(({x})*{s}+0.5E0) AS BIGINT)) AS DOUBLE)/{s})"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE)/NULLIF(CAST({b} AS DOUBLE),0))"


_BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {}


def block(name: str, body: str, *needs: str) -> None:
    _BLOCKS[name] = (needs, body)


def sql(final: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in _BLOCKS[name][0]:
            visit(dep)
        ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({_BLOCKS[n][1]})" for n in ordered) + "\n" + final


block(
    "base",
    """SELECT l_orderkey ok,
    CASE l_linenumber % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 7 ELSE 9 END AS vendor_id,
    CAST(l_suppkey % 26 AS INT) AS pu_location_id, CAST(l_partkey % 26 AS INT) AS do_location_id,
    make_timestamp(CAST((1704067200 + ((l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 786240)*60
                         + (l_orderkey*13) % 60)*1000000 AS BIGINT)) AS pickup,
    CAST(l_quantity AS BIGINT)*60 + l_linenumber*7 - 90 AS dur,
    CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_linenumber % 6 END AS passenger_count,
    l_quantity/4.0E0 - 0.25E0 AS trip_distance,
    CASE WHEN l_partkey % 40 = 0 THEN 99 WHEN l_partkey % 41 = 0 THEN NULL
         ELSE CAST(1 + l_partkey % 5 AS INT) END AS rate_code_id,
    CAST(l_orderkey % 7 AS INT) AS payment_type,
    CASE WHEN l_orderkey % 33 = 0 THEN -1 ELSE 1 END * CAST(floor(l_extendedprice/10.0E0) AS BIGINT) AS fc,
    CAST(round(l_discount*100) AS BIGINT) disc, CAST(round(l_tax*100) AS BIGINT) tax,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_linenumber % 3 AS DOUBLE)/2.0E0 AS extra,
    CASE WHEN l_suppkey % 10 = 0 THEN 6.55E0 ELSE 0.0E0 END AS tolls_amount
  FROM lineitem""",
)
block(
    "first_delivery",
    """SELECT vendor_id, rate_code_id, pu_location_id, do_location_id, pickup AS tpep_pickup_datetime,
    pickup + INTERVAL 1 SECOND * dur AS tpep_dropoff_datetime, passenger_count, trip_distance, store_and_fwd_flag,
    payment_type, fc/100.0E0 AS fare_amount, extra, 0.5E0 AS mta_tax,
    CAST(floor(fc*disc/100.0E0) AS BIGINT)/100.0E0 AS raw_tip, tolls_amount,
    1.0E0 AS improvement_surcharge, 2.5E0 AS congestion_surcharge,
    CASE WHEN pu_location_id IN (3,7) THEN 1.75E0 ELSE 0.0E0 END AS airport_fee,
    CASE WHEN pickup >= TIMESTAMP '2025-01-05 00:00:00' AND pu_location_id % 5 = 1 THEN 0.75E0 END AS cbd_congestion_fee,
    (fc + CAST(floor(fc*tax/100.0E0) AS BIGINT) + 250)/100.0E0 AS total_amount,
    CASE WHEN ok % 100 = 0 THEN '2024-01' ELSE strftime(pickup,'%Y-%m') END AS _batch_id, 0 AS ing
  FROM base""",
    "base",
)
block(
    "raw",
    """SELECT * FROM first_delivery UNION ALL
  SELECT * REPLACE (total_amount + 1 AS total_amount, 1 AS ing) FROM first_delivery WHERE do_location_id = 4""",
    "first_delivery",
)
block(
    "typed",
    """SELECT md5(CAST(vendor_id AS VARCHAR) || '|' || CAST(epoch_us(tpep_pickup_datetime) AS VARCHAR) || '|'
      || CAST(pu_location_id AS VARCHAR)) AS trip_id, *,
    CASE WHEN payment_type = 1 THEN raw_tip END AS tip_amount
  FROM raw""",
    "raw",
)
block(
    "latest",
    """SELECT * FROM typed QUALIFY row_number() OVER (
    PARTITION BY vendor_id, tpep_pickup_datetime, pu_location_id
    ORDER BY ing DESC, do_location_id NULLS FIRST, total_amount NULLS FIRST, fare_amount NULLS FIRST,
      tpep_dropoff_datetime NULLS FIRST, trip_distance NULLS FIRST, passenger_count NULLS FIRST,
      payment_type NULLS FIRST, rate_code_id NULLS FIRST) = 1""",
    "typed",
)
block(
    "silver",
    """SELECT * FROM latest
  WHERE passenger_count > 0 AND trip_distance > 0 AND fare_amount > 0
    AND tpep_dropoff_datetime > tpep_pickup_datetime AND rate_code_id <> 99
    AND year(tpep_pickup_datetime) BETWEEN 2015 AND 2030
    AND strftime(tpep_pickup_datetime, '%Y-%m') = _batch_id""",
    "latest",
)
block(
    "zones",
    """SELECT CAST(n_nationkey AS INT) AS LocationID,
    CASE r_name WHEN 'AMERICA' THEN 'Manhattan' WHEN 'ASIA' THEN 'Queens' WHEN 'EUROPE' THEN 'Brooklyn'
      WHEN 'AFRICA' THEN 'Bronx' ELSE 'Staten Island' END AS Borough,
    n_name AS Zone, CASE r_name WHEN 'AMERICA' THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
block(
    "hourly",
    f"""SELECT md5(strftime(date_trunc('hour', s.tpep_pickup_datetime), '%Y-%m-%d %H:00:00.000') || '|'
      || CAST(s.pu_location_id AS VARCHAR) || '|' || CAST(s.vendor_id AS VARCHAR)) AS fct_id,
    date_trunc('hour', s.tpep_pickup_datetime) AS pickup_hour,
    CAST(date_trunc('hour', s.tpep_pickup_datetime) AS DATE) AS pickup_date,
    hour(date_trunc('hour', s.tpep_pickup_datetime)) AS hour_of_day,
    strftime(date_trunc('hour', s.tpep_pickup_datetime), '%a') AS day_of_week,
    s.pu_location_id,
    COALESCE(z.Borough, 'Unknown') AS pickup_borough, COALESCE(z.Zone, 'Unknown') AS pickup_zone,
    COALESCE(z.service_zone, 'Unknown') AS service_zone,
    s.vendor_id,
    CASE s.vendor_id WHEN 1 THEN 'CMT' WHEN 2 THEN 'Curb' WHEN 6 THEN 'Myle' WHEN 7 THEN 'Helix'
      ELSE 'Unknown' END AS vendor_name,
    count(*) AS trip_count, CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    {half_up(ratio("sum(passenger_count)", "count(passenger_count)"), 2)} AS avg_passengers_per_trip,
    {half_up(total("total_amount"), 2)} AS total_revenue,
    {half_up(total("fare_amount"), 2)} AS total_fare,
    {half_up(ratio(total("total_amount"), "count(*)"), 2)} AS revenue_per_trip,
    {half_up(total("trip_distance"), 2)} AS total_distance_miles,
    {half_up(ratio(total("trip_distance"), "count(trip_distance)"), 2)} AS avg_distance_miles,
    {half_up(ratio(total("total_amount"), total("trip_distance")), 2)} AS revenue_per_mile,
    {half_up(ratio("sum(date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime))", "count(*)"), 1)}
      AS avg_trip_duration_minutes,
    {half_up(ratio(total("CASE WHEN tip_amount IS NOT NULL AND fare_amount > 0 THEN tip_amount/fare_amount*100.0E0 END", 6),
      "count(CASE WHEN tip_amount IS NOT NULL AND fare_amount > 0 THEN 1 END)"), 1)} AS avg_tip_pct,
    {half_up(ratio("count(CASE WHEN payment_type = 1 THEN 1 END)*100.0E0", "count(*)"), 1)} AS credit_card_trip_pct,
    {half_up(total("COALESCE(cbd_congestion_fee, 0.0E0)"), 2)} AS total_congestion_fees,
    {half_up(total("COALESCE(airport_fee, 0.0E0)"), 2)} AS total_airport_fees
  FROM silver s LEFT JOIN zones z ON s.pu_location_id = z.LocationID
  WHERE payment_type NOT IN (3, 4, 6)
  GROUP BY date_trunc('hour', s.tpep_pickup_datetime), s.pu_location_id, s.vendor_id, z.Borough, z.Zone, z.service_zone""",
    "silver",
    "zones",
)
block(
    "daily",
    f"""SELECT md5(strftime(pickup_date, '%Y-%m-%d') || '|' || CAST(pu_location_id AS VARCHAR)) AS fct_id,
    pickup_date, day_of_week, pu_location_id, pickup_borough, pickup_zone, service_zone,
    CAST(sum(trip_count) AS BIGINT) AS trip_count, CAST(sum(total_passengers) AS BIGINT) AS total_passengers,
    {half_up(ratio("sum(total_passengers)", "sum(trip_count)"), 2)} AS avg_passengers_per_trip,
    {half_up(total("total_revenue"), 2)} AS total_revenue,
    {half_up(total("total_fare"), 2)} AS total_fare,
    {half_up(ratio(total("total_revenue"), "sum(trip_count)"), 2)} AS revenue_per_trip,
    {half_up(total("total_distance_miles"), 2)} AS total_distance_miles,
    {half_up(ratio(total("total_distance_miles"), "sum(trip_count)"), 2)} AS avg_distance_miles,
    {half_up(ratio(total("total_revenue"), total("total_distance_miles")), 2)} AS revenue_per_mile,
    {half_up(ratio(total("avg_trip_duration_minutes*trip_count"), "sum(trip_count)"), 1)} AS avg_trip_duration_minutes,
    {half_up(ratio(total("avg_tip_pct*(credit_card_trip_pct/100.0E0*trip_count)", 6),
      total("CASE WHEN avg_tip_pct IS NOT NULL THEN credit_card_trip_pct/100.0E0*trip_count END", 6)), 1)} AS avg_tip_pct,
    {half_up(ratio(total("credit_card_trip_pct*trip_count"), "sum(trip_count)"), 1)} AS credit_card_trip_pct,
    {half_up(total("total_congestion_fees"), 2)} AS total_congestion_fees,
    {half_up(total("total_airport_fees"), 2)} AS total_airport_fees
  FROM hourly
  GROUP BY pickup_date, day_of_week, pu_location_id, pickup_borough, pickup_zone, service_zone""",
    "hourly",
)
