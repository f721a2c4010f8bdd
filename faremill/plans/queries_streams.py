"""Streaming queries over files written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import exact_sum, round_half_up
from ..operators.quality import DataQualityError
from ..session import materialise, scratch_path
from ..sources import tables
from ..streaming import facts, ingest
from . import inputs, oracle
from .catalog import DT, TS, register
from .monthly import Lake, run_month
from .oracle import block, half_up, total


@register("stream_file_ingest", (
    f"SELECT {DT.format('day')}, event_type, count(*) AS n_events, {half_up(total('value'), 2)} AS value"
    " FROM (SELECT CAST(ts AS DATE) AS day, * FROM events) e GROUP BY e.day, event_type"))
def _ingest(spark, sf_dir):
    """Files arrive in two lots; three runs of the ingest load each file once."""
    root = scratch_path(spark, "stream")
    events = inputs.table(spark, sf_dir, "events")
    first = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for lot in (first, ~first, None):
        if lot is not None:
            events.filter(lot).withColumn("day", F.date_format("ts", "yyyy-MM-dd")).write.mode("append").partitionBy("day").parquet(f"{root}/in")
        stream = ingest.file_stream(spark, f"{root}/in", events.schema, max_files=50)
        ingest.land_available(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), round_half_up(exact_sum("value"), 2).alias("value"))


# Incremental runs clean batch by batch, so copies are compared within their batch.
for _name in ("latest", "silver", "hourly"):
    _needs, _body = oracle._BLOCKS[_name]
    _body = _body.replace("PARTITION BY vendor_id,", "PARTITION BY _batch_id, vendor_id,")
    _body = _body.replace("FROM latest", "FROM latest_by_batch").replace("FROM silver s", "FROM silver_by_batch s")
    block(f"{_name}_by_batch", _body, *[f"{n}_by_batch" if n in ("latest", "silver") else n for n in _needs])

_MONTHS = oracle.sql(
    "SELECT strftime(pickup_hour, '%Y-%m') AS pickup_month, count(*) AS hourly_rows, CAST(sum(trip_count) AS BIGINT) AS trip_count,"
    f" {half_up(total('total_revenue'), 2)} AS total_revenue FROM hourly_by_batch GROUP BY 1", "hourly_by_batch")


def _months(hourly):
    return hourly.groupBy("pickup_month").agg(
        F.count(F.lit(1)).alias("hourly_rows"), F.sum("trip_count").alias("trip_count"), round_half_up(exact_sum("total_revenue"), 2).alias("total_revenue"))


@register("stream_gold_refresh", _MONTHS)
def _gold_stream(spark, sf_dir):
    """First deliveries, then re-deliveries of the same months, through micro-batches into gold."""
    root = scratch_path(spark, "stream-gold")
    lake = Lake(f"{root}/lake")
    raw = inputs.raw_trips(spark, sf_dir).drop("_source_file")
    zones = materialise(inputs.zones(spark, sf_dir), "zones")
    redelivered = F.col("_ingested_at") > F.lit("2025-07-01 00:00:00").cast("timestamp_ntz")
    for lot in (~redelivered, redelivered):
        raw.filter(lot).write.mode("append").parquet(f"{root}/in")
        stream = ingest.file_stream(spark, f"{root}/in", raw.schema)
        ingest.apply_available(stream, f"{root}/checkpoint", facts.gold_from_batches(spark, lake, zones))
    return _months(tables.read_table(spark, lake.hourly))


@register("incremental_monthly_runs", _MONTHS)
def _incremental(spark, sf_dir):
    """Three runs with a late month end in the same gold as one full run."""
    lake = Lake(scratch_path(spark, "lake"))
    raw = materialise(inputs.raw_trips(spark, sf_dir), "raw")
    zones = materialise(inputs.zones(spark, sf_dir), "zones")
    late = F.col("_batch_id") == "2024-05"
    for lot in ((F.col("_batch_id") < "2024-10") & ~late, ~late, F.lit(True)):
        run_month(spark, lake, raw.filter(lot), zones)
    return _months(tables.read_table(spark, lake.hourly))


@register("redelivered_file", _MONTHS)
def _redelivered(spark, sf_dir):
    """A second file of months that are already loaded lands and rebuilds them; a third run finds nothing new."""
    lake = Lake(scratch_path(spark, "lake"))
    second = F.col("_ingested_at") > F.lit("2025-07-01 00:00:00").cast("timestamp_ntz")
    name = F.when(second, F.concat(F.lit("again_"), "_source_file")).otherwise(F.col("_source_file"))
    raw = materialise(inputs.raw_trips(spark, sf_dir).withColumn("_source_file", name), "raw")
    zones = materialise(inputs.zones(spark, sf_dir), "zones")
    for lot in (~second, F.lit(True), F.lit(True)):
        run_month(spark, lake, raw.filter(lot), zones)
    return _months(tables.read_table(spark, lake.hourly))


@register("emptied_month", f"SELECT * FROM ({_MONTHS}) WHERE pickup_month <> '2024-03'")
def _emptied(spark, sf_dir):
    """A later file takes back every trip of one month: all layers lose the month."""
    lake = Lake(scratch_path(spark, "lake"))
    raw = materialise(inputs.raw_trips(spark, sf_dir), "raw")
    zones = materialise(inputs.zones(spark, sf_dir), "zones")
    back = raw.filter("_batch_id = '2024-03'").withColumns({
        "fare_amount": F.lit(-1.0), "_source_file": F.lit("back.parquet"), "_ingested_at": F.expr("_ingested_at + INTERVAL 9 DAY")})
    run_month(spark, lake, raw, zones)
    run_month(spark, lake, raw.unionByName(back), zones)
    return _months(tables.read_table(spark, lake.hourly))


@register("rerun_after_failed_gate", _MONTHS)
def _rerun(spark, sf_dir):
    """Doubled zones break the key of the hourly fact: nothing is published, and the next run makes it good."""
    lake = Lake(scratch_path(spark, "lake"))
    raw = materialise(inputs.raw_trips(spark, sf_dir), "raw")
    zones = materialise(inputs.zones(spark, sf_dir), "zones")
    try:
        run_month(spark, lake, raw, zones.unionByName(zones))
    except DataQualityError:
        if tables.exists(spark, lake.hourly):
            raise
    else:
        raise RuntimeError("the gate let doubled keys pass")
    run_month(spark, lake, raw, zones)
    return _months(tables.read_table(spark, lake.hourly))


@register("stream_hourly_counts", (
    "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, CAST(user_id % 25 AS BIGINT) AS key, count(*) AS n FROM events"
    " WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR GROUP BY 1, 2"))
def _hourly_stream(spark, sf_dir):
    """Event-time counts; hours are emitted once the watermark has passed them."""
    root = scratch_path(spark, "stream-hours")
    events = inputs.table(spark, sf_dir, "events")
    events.write.parquet(f"{root}/in")
    stream = ingest.file_stream(spark, f"{root}/in", events.schema)
    counts = facts.hourly_counts(stream, "ts", F.col("user_id") % 25)
    ingest.land_available(counts, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")
