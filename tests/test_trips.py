"""Golden rows for the trip layers."""

from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from faremill.functions.calendar import minutes_between
from faremill.operators import gold, quality, silver
from faremill.plans import catalog, inputs
from faremill.schema import ZONE_SCHEMA

PICKUP = datetime(2024, 3, 5, 10, 0, 30)


def trip(**changes):
    row = dict(
        VendorID=1, RatecodeID=1.0, PULocationID=7, DOLocationID=8, tpep_pickup_datetime=PICKUP,
        tpep_dropoff_datetime=datetime(2024, 3, 5, 10, 20, 0), passenger_count=1.0, trip_distance=2.0, store_and_fwd_flag="N",
        payment_type=1, fare_amount=10.0, extra=0.0, mta_tax=0.5, tip_amount=2.0, tolls_amount=0.0, improvement_surcharge=1.0,
        congestion_surcharge=2.5, airport_fee=0.0, cbd_congestion_fee=None, total_amount=16.0, _source_file="f",
        _ingested_at=datetime(2024, 5, 1), _batch_id="2024-03",
    )
    return row | changes


RAW_DDL = (
    "VendorID int, RatecodeID double, PULocationID int, DOLocationID int, tpep_pickup_datetime timestamp_ntz,"
    " tpep_dropoff_datetime timestamp_ntz, passenger_count double, trip_distance double, store_and_fwd_flag string, payment_type int,"
    " fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,"
    " congestion_surcharge double, airport_fee double, cbd_congestion_fee double, total_amount double, _source_file string,"
    " _ingested_at timestamp_ntz, _batch_id string"
)
NAMES = [c.split()[0] for c in RAW_DDL.split(", ")]


def raw(spark, *rows):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], RAW_DDL)


def clean(spark, *rows):
    return silver.build_silver(silver.typed_from_columns(raw(spark, *rows)))


def zones(spark):
    return spark.createDataFrame(
        [(7, "Queens", "Astoria", "Boro Zone"), (264, "Unknown", "N/A", "N/A")], ZONE_SCHEMA
    )


def test_bad_newest_copy_removes_the_trip(spark):
    older = trip()
    newer = trip(_ingested_at=datetime(2024, 6, 1), fare_amount=-5.0)
    assert clean(spark, older, newer).count() == 0
    assert clean(spark, older, trip(_ingested_at=datetime(2024, 6, 1), fare_amount=7.0)).first().fare_amount == 7.0


def test_trip_id_text_and_null_part(spark):
    df = silver.typed_from_columns(raw(spark, trip(), trip(VendorID=None)))
    micros = int((PICKUP - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    import hashlib

    ids = {r.vendor_id: r.trip_id for r in df.collect()}
    assert ids[1] == hashlib.md5(f"1|{micros}|7".encode()).hexdigest()
    assert ids[None] is None


def test_equal_load_times_give_one_winner_for_any_order(spark):
    rows = [trip(DOLocationID=d, total_amount=10.0 + d) for d in (9, 4, 6)]
    winners = set()
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        for parts in (1, 3):
            typed = silver.typed_from_columns(raw(spark, *order).repartition(parts))
            winners.add(silver.build_silver(typed).first().do_location_id)
    assert winners == {4}


@pytest.mark.parametrize(
    "change",
    [
        {"RatecodeID": None}, {"RatecodeID": 99.0}, {"passenger_count": None}, {"passenger_count": 0.0}, {"trip_distance": 0.0},
        {"fare_amount": 0.0}, {"tpep_dropoff_datetime": PICKUP}, {"tpep_pickup_datetime": datetime(2009, 3, 5), "_batch_id": "2009-03"},
        {"tpep_pickup_datetime": datetime(2024, 2, 29, 23, 59)}, {"_batch_id": "not a month"},
    ],
)
def test_rejected_rows(spark, change):
    assert clean(spark, trip(**change)).count() == 0


def test_null_payment_is_kept_in_silver_but_not_in_revenue(spark):
    rows = clean(spark, trip(payment_type=None))
    assert rows.count() == 1 and gold.revenue_trips(rows).count() == 0
    assert clean(spark, trip(payment_type=2)).first().tip_amount is None


def test_float_counts_are_rounded(spark):
    assert clean(spark, trip(passenger_count=1.6)).first().passenger_count == 2


def test_minutes_count_boundaries(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 10:00:59', TIMESTAMP_NTZ'2024-01-01 10:01:01', 1),"
        " (TIMESTAMP_NTZ'2024-01-01 10:01:00', TIMESTAMP_NTZ'2024-01-01 10:01:59', 0) AS t(a, b, n)"
    )
    assert all(r.m == r.n for r in df.withColumn("m", minutes_between("a", "b")).collect())


def test_unmatched_and_literal_unknown_zone(spark):
    trips = clean(spark, trip(), trip(PULocationID=264), trip(PULocationID=999))
    rows = {r.pu_location_id: r for r in gold.build_hourly(trips, zones(spark)).collect()}
    assert rows[999].pickup_zone == "Unknown" and rows[264].pickup_zone == "N/A" and rows[7].pickup_borough == "Queens"
    assert [r.pu_location_id for r in gold.orphan_zones(trips, zones(spark)).collect()] == [999]


def test_daily_tip_leaves_out_hours_without_tips(spark):
    a = trip(tip_amount=2.0)
    b = trip(payment_type=2, tpep_pickup_datetime=datetime(2024, 3, 5, 12), tpep_dropoff_datetime=datetime(2024, 3, 5, 13))
    hourly = gold.build_hourly(clean(spark, a, b), zones(spark))
    assert sorted(r.avg_tip_pct or -1 for r in hourly.collect()) == [-1, 20.0]
    day = gold.build_daily(hourly).first()
    assert day.trip_count == 2 and day.avg_tip_pct == 20.0 and day.credit_card_trip_pct == 50.0


def test_variant_and_native_casts_agree(spark):
    from faremill.sources.bronze import as_variant_rows

    source = raw(spark, trip(), trip(passenger_count=None, cbd_congestion_fee=0.75))
    landed = as_variant_rows(source, F.col("_batch_id"), F.col("_ingested_at"))
    assert sorted(map(str, silver.typed_from_variant(landed).collect())) == sorted(map(str, silver.typed_from_columns(source).collect()))


def test_missing_field_reads_as_null(spark):
    assert silver.typed_from_columns(raw(spark, trip()).drop("cbd_congestion_fee")).first().cbd_congestion_fee is None


def test_quality_gate(spark):
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    quality.require_clean(quality.table_tests(good, "t", "k", ["v"]))
    bad = spark.createDataFrame([("a", None), ("a", 2)], "k string, v int")
    tests = {(r.column_name, r.check_name): r.failures for r in quality.table_tests(bad, "t", "k", ["v"]).collect()}
    assert tests == {("v", "not_null"): 1, ("k", "unique"): 1}
    with pytest.raises(quality.DataQualityError):
        quality.require_clean(quality.table_tests(bad, "t", "k", ["v"]))


def test_daily_sums_equal_hourly_sums(spark, sf_dir):
    from faremill.session import materialise

    hourly = materialise(catalog.hourly_of(spark, sf_dir), "hourly")
    daily = gold.build_daily(hourly)
    a = hourly.agg(F.sum("trip_count"), F.round(F.sum("total_revenue"), 2)).first()
    b = daily.agg(F.sum("trip_count"), F.round(F.sum("total_revenue"), 2)).first()
    assert tuple(a) == tuple(b)


def test_plans_broadcast_the_dimension_and_limit_copies_before_the_shuffle(spark, sf_dir):
    plan = catalog.hourly_of(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert plan.count("WindowGroupLimit") == 2
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    pruned = catalog.hourly_of(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in pruned and "l_linestatus" not in pruned


def test_plans_do_not_depend_on_size_and_start_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    shapes = []
    for sf in ("0.001", "0.1"):
        plan = catalog.hourly_of(spark, f"/root/testdata/sf{sf}")._jdf.queryExecution().optimizedPlan().toString()
        shapes.append([line.split("[")[0].split("(")[0].strip(" +-:").split(" ")[0] for line in plan.splitlines()])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert shapes[0] == shapes[1]
    # Reading a footer for the schema is the only job a plan may start.
    assert len(tracker.getJobIdsForGroup("plan-only")) <= 6


def test_row_is_what_the_adapter_promises(spark, sf_dir):
    assert inputs.raw_trips(spark, sf_dir).count() == 6242
    assert catalog.silver_of(spark, sf_dir).count() == 4544
    assert isinstance(inputs.zones(spark, sf_dir).first(), Row)
    assert catalog.daily_of(spark, sf_dir).agg(F.min("pickup_date")).first()[0] >= date(2024, 1, 1)


def test_exact_sums_hold_beyond_a_bigint_of_units(spark):
    from faremill.functions.numeric import exact_sum

    rows = spark.createDataFrame([(9.0e12,), (9.0e12,), (9.0e12,), (0.25,), (-0.5,), (None,)], "v double")
    assert rows.agg(exact_sum("v", 6).alias("s"), exact_sum(F.col("v"), 6).alias("t")).first()[:] == (27e12 - 0.25, 27e12 - 0.25)
    signs = spark.createDataFrame([(-1.5,), (-2.25,), (1e-4,)], "v double")
    assert signs.agg(exact_sum("v").alias("s")).first().s == -3.7499
    assert signs.filter("v > 9").agg(exact_sum("v").alias("s")).first().s is None
