"""Stateful gold refresh: any order of deliveries, replays and taken-back trips."""

import pytest
from pyspark.sql import functions as F

from faremill.operators import gold, silver
from faremill.plans import catalog, inputs
from faremill.plans.monthly import Lake, run_month
from faremill.schema import TripRules
from faremill.session import materialise, scratch_path
from faremill.sources import tables
from faremill.streaming import facts

MONTHS = ["2024-01", "2024-02"]


@pytest.fixture(scope="module")
def trips(spark):
    """Two months; a third delivery takes some trips back by a bad copy, a fourth brings older copies of them."""
    raw = inputs.raw_trips(spark, "/root/testdata/sf0.001").filter(F.col("_batch_id").isin(MONTHS))
    some = raw.filter("_ingested_at = TIMESTAMP_NTZ '2025-07-01 00:00:00' and PULocationID % 3 = 0")
    bad = some.withColumns({"fare_amount": F.lit(-1.0), "_ingested_at": F.expr("_ingested_at + INTERVAL 9 DAY")})
    older = some.withColumns({"total_amount": F.lit(1e6), "_ingested_at": F.expr("_ingested_at - INTERVAL 9 DAY")})
    return materialise(raw.withColumn("lot", F.expr("if(_ingested_at > TIMESTAMP_NTZ '2025-07-01 00:00:00', 1, 0)")).unionByName(bad.withColumn("lot", F.lit(2))).unionByName(older.withColumn("lot", F.lit(3))), "lots")


def content(spark, *paths):
    return [sorted(map(str, tables.read_table(spark, p).collect())) for p in paths]


@pytest.fixture(scope="module")
def whole(spark, trips):
    zones, lake = materialise(inputs.zones(spark, "/root/testdata/sf0.001"), "zones"), Lake(scratch_path(spark, "lake"))
    run_month(spark, lake, trips.drop("lot"), zones)
    return zones, lake


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]])
def test_any_order_ends_in_the_facts_of_one_run(spark, trips, whole, order):
    zones, other = whole
    lake = Lake(scratch_path(spark, "lake"))
    step = facts.gold_from_batches(spark, lake, zones)
    for number, lot in enumerate(order):
        step(trips.filter(F.col("lot") == lot).drop("lot"), number)
        if number == 1:
            step(trips.filter(F.col("lot") == lot).drop("lot"), number)  # a replay changes nothing
    step(trips.filter(F.col("lot") == 0).drop("lot"), len(order))  # nor does a second delivery of the same copies
    step(trips.limit(0).drop("lot"), len(order) + 1)
    assert content(spark, lake.hourly, lake.daily) == content(spark, other.hourly, other.daily)
    kept = facts.kept_trips(spark, lake, MONTHS)
    names = [c for c in kept.columns if c not in ("_source_file",)]
    mine, theirs = kept.select(*names), tables.read_table(spark, other.silver).select(*names)
    assert mine.exceptAll(theirs).count() == theirs.exceptAll(mine).count() == 0 and mine.count() > 0


def test_an_emptied_month_leaves_the_facts(spark, trips, whole):
    zones, lake = whole[0], Lake(scratch_path(spark, "lake"))
    step = facts.gold_from_batches(spark, lake, zones)
    first = trips.filter("lot < 2").drop("lot")
    step(first, 0)
    back = first.filter("_batch_id = '2024-02'").withColumns({"fare_amount": F.lit(-1.0), "_ingested_at": F.expr("_ingested_at + INTERVAL 30 DAY")})
    step(back, 1)
    for path in (lake.hourly, lake.daily):
        assert tables.touched_values(tables.read_table(spark, path), "pickup_month") == ["2024-01"]


def test_moments_give_the_hourly_fact(spark):
    """Sums of parts, with rows added and taken back, are the fact that the whole gives at once."""
    rows = catalog.silver_of(spark, "/root/testdata/sf0.001")
    zones = inputs.zones(spark, "/root/testdata/sf0.001")
    third = F.pmod(F.xxhash64("trip_id"), F.lit(3))
    parts = [gold.hourly_moments(rows.filter(third == i).withColumn("sign", F.lit(1))) for i in range(3)]
    parts += [gold.hourly_moments(rows.filter(third == 0).withColumn("sign", F.lit(s))) for s in (1, -1)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    mine, theirs = gold.hourly_from_moments(every, zones), gold.build_hourly(rows, zones)
    assert mine.columns == theirs.columns and sorted(map(str, mine.collect())) == sorted(map(str, theirs.collect()))


def test_changed_rows(spark):
    schema = "k int, at int, tie int, v string"
    old = spark.createDataFrame([(1, 5, 1, "a"), (2, 5, 1, "b"), (3, 5, 1, "c"), (None, None, 1, "n"), (9, 1, 1, "stays")], schema)
    new = spark.createDataFrame([(1, 6, 1, "newer"), (2, 4, 1, "older"), (3, 5, None, "ties lower"), (4, 1, 1, "first"), (4, 2, 1, "second"), (None, 0, 1, "known")], schema)
    got = sorted((r["k"] or 0, r["sign"], r["v"]) for r in silver.changed_rows(new, old, ["k"], "at", ["tie"]).collect())
    assert got == [(0, -1, "n"), (0, 1, "known"), (1, -1, "a"), (1, 1, "newer"), (3, -1, "c"), (3, 1, "ties lower"), (4, 1, "second")]
    assert silver.changed_rows(old, old, ["k"], "at", ["tie"]).count() == 0 and TripRules().dedup_keys


def test_changed_rows_shuffle_each_side_once(spark):
    """The window over the log and the join share a shuffle; an empty log is not joined at all."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).selectExpr("CAST(id % 7 AS INT) AS k", "CAST(id AS INT) AS at", "1 AS tie", "'x' AS v")
        old = silver.latest_by_key(silver.keyed(rows, ["k"]), [silver.KEY], "at")
        shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert shuffles(silver.changed_rows(rows, old, ["k"], "at", ["tie"])) == 2
        first = silver.changed_rows(rows, None, ["k"], "at", ["tie"])
        assert shuffles(first) == 1 and sorted((r["k"], r["at"], r["sign"]) for r in first.collect()) == [(k, max(range(k, 100, 7)), 1) for k in range(7)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_log_has_no_trip_ids(spark, trips, whole):
    lake = Lake(scratch_path(spark, "lake"))
    facts.gold_from_batches(spark, lake, whole[0])(trips.filter("lot = 0").drop("lot"), 0)
    assert "trip_id" not in tables.read_table(spark, lake.winners).columns
    assert "trip_id" in facts.kept_trips(spark, lake, MONTHS).columns
