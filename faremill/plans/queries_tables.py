"""Queries over sources and sinks: scans, variants, ledgers, deletes, upserts, reruns.

Tables are written to the scratch folder, read back and compared with the SQL twin.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.calendar import month_text
from ..functions.numeric import exact_sum, round_half_up
from ..operators import gold, silver
from ..operators.quality import DataQualityError
from ..session import materialise, scratch_path, unsorted_writes
from ..sources import bronze, manifest, months, seeds, tables
from ..sources.bucketed import BucketedTable
from . import inputs, oracle
from .catalog import DT, daily_of, hourly_of, register, typed
from .monthly import Lake, book_of
from .oracle import half_up, total

MONTH = "pickup_month"
BY_BATCH = "_batch_id={month}"


def _batch_of_file():
    return F.regexp_extract("file", r"_batch_id=([0-9-]+)", 1)


def _landed(spark, sf_dir, label):
    path = scratch_path(spark, label)
    inputs.raw_trips(spark, sf_dir).drop("_source_file").write.partitionBy("_batch_id").parquet(path)
    return path


@register("scan_months", oracle.sql(
    "SELECT _batch_id, count(*) AS row_count, " + half_up(total("total_amount"), 2) + " AS total_amount FROM raw"
    " WHERE _batch_id IN ('2024-03', '2025-01') GROUP BY 1", "raw"))
def _scan(spark, sf_dir):
    """Scan restricted to two month patterns; the batch is read off each row's file."""
    path = _landed(spark, sf_dir, "months")
    rows = bronze.scan_months(spark, path, ["2024-03", "2025-01"], BY_BATCH)
    batch = F.regexp_extract("_source_file", r"_batch_id=([0-9-]+)", 1).alias("_batch_id")
    return rows.groupBy(batch).agg(
        F.count(F.lit(1)).alias("row_count"), round_half_up(exact_sum("total_amount"), 2).alias("total_amount"))


@register("rows_per_source_file", oracle.sql("SELECT _batch_id, count(*) AS row_count FROM raw GROUP BY 1", "raw"))
def _per_file(spark, sf_dir):
    """Rows per stored file, summed per folder (file names are not stable)."""
    path = _landed(spark, sf_dir, "files")
    files = bronze.rows_per_file(bronze.scan_months(spark, path, ["*"], BY_BATCH))
    batch = F.regexp_extract("_source_file", r"_batch_id=([0-9-]+)", 1).alias("_batch_id")
    return files.groupBy(batch).agg(F.sum("row_count").alias("row_count"))


@register("variant_landing", oracle.sql(
    "SELECT trip_id, CAST(rate_code_id AS BIGINT) AS rate_code_id, CAST(passenger_count AS BIGINT) AS passenger_count,"
    " tip_amount, cbd_congestion_fee, total_amount, store_and_fwd_flag, _batch_id FROM typed", "typed"))
def _variant(spark, sf_dir):
    """Rows landed as variants, read back and cast field by field."""
    path = scratch_path(spark, "variant")
    raw = inputs.raw_trips(spark, sf_dir)
    bronze.land_variants(raw, path, F.col("_batch_id"), F.col("_ingested_at"))
    return silver.typed_from_variant(spark.read.parquet(path)).select(
        "trip_id", "rate_code_id", "passenger_count", "tip_amount", "cbd_congestion_fee", "total_amount", "store_and_fwd_flag", "_batch_id")


@register("variant_props", (
    "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n_events, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total FROM events GROUP BY 1"))
def _variant_props(spark, sf_dir):
    """JSON text landed as a variant; one field of it is read back as text and as a number."""
    path = scratch_path(spark, "props")
    events = inputs.table(spark, sf_dir, "events")
    events.select(F.try_parse_json("props").alias("props")).write.parquet(path)
    rows = spark.read.parquet(path)
    text = F.try_variant_get("props", "$.k", "string")
    return rows.groupBy(text.alias("k")).agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.try_variant_get("props", "$.k", "bigint")).alias("k_total"))


@register("load_ledger", oracle.sql(
    "SELECT _batch_id, count(*) AS first_load, CAST(0 AS BIGINT) AS second_load FROM raw WHERE _batch_id <> '2024-02' GROUP BY 1"
    " UNION ALL SELECT _batch_id, CAST(0 AS BIGINT), count(*) FROM raw WHERE _batch_id = '2024-02' GROUP BY 1", "raw"))
def _ledger(spark, sf_dir):
    """One month arrives late: the second load takes exactly the unseen batch."""
    raw = inputs.raw_trips(spark, sf_dir).select("_batch_id")
    path = scratch_path(spark, "ledger")
    raw.filter(F.col("_batch_id") != "2024-02").write.parquet(path)
    have = spark.read.parquet(path)
    first = have.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("first_load"))
    second = bronze.rows_of_unseen(raw, have).groupBy("_batch_id").agg(F.count(F.lit(1)).alias("second_load"))
    return first.join(second, "_batch_id", "full_outer").na.fill(0)


@register("load_reconciliation", oracle.sql(
    "SELECT _batch_id, count(*) FILTER (WHERE ing = 0) AS rows_before, count(*) AS rows_after,"
    " count(*) FILTER (WHERE ing = 1) AS rows_loaded, count(*) FILTER (WHERE ing = 1) = 0 AS already_loaded FROM raw GROUP BY 1", "raw"))
def _reconcile(spark, sf_dir):
    """Rows per batch before and after the second delivery."""
    raw = inputs.raw_trips(spark, sf_dir)
    before = raw.filter(F.col("_ingested_at") == F.lit("2025-07-01 00:00:00").cast("timestamp_ntz"))
    return bronze.reconcile(before, raw)


@register("manifest_loads", oracle.sql(
    "SELECT _batch_id, CASE WHEN _batch_id < '2024-10' AND _batch_id <> '2024-05' THEN 1 ELSE 2 END AS brought_by, count(*) AS row_count,"
    " CAST(1 AS BIGINT) AS files, CAST(0 AS BIGINT) AS loaded_again, true AS known_by_then, count(*) AS visible_rows FROM raw GROUP BY 1", "raw"))
def _manifest(spark, sf_dir):
    """A folder of month files, loaded as it fills: each file once, and a third run takes none.

    An orphan of a load that never committed lies in bronze and is seen by nobody.
    """
    root = scratch_path(spark, "manifest")
    raw = inputs.raw_trips(spark, sf_dir).drop("_source_file", "_ingested_at")
    schema = raw.drop("_batch_id").schema
    lake = Lake(f"{root}/lake")
    book, steps = book_of(spark, lake), []
    early = (F.col("_batch_id") < "2024-10") & (F.col("_batch_id") != "2024-05")
    for lot in (early, ~early, None):
        if lot is not None:
            with unsorted_writes(spark):
                raw.where(lot).repartition("_batch_id").write.mode("append").partitionBy("_batch_id").parquet(f"{root}/in")
        steps.append(materialise(manifest.load_files(spark, book, lake.bronze, f"{root}/in", schema, _batch_of_file()), "step"))
    raw.limit(5).withColumns({manifest.LOAD: F.lit("crashed"), manifest.REJECT: F.lit(None).cast("string"), "_source_file": F.lit("x"), "_ingested_at": F.current_timestamp().cast("timestamp_ntz")}).write.mode("append").partitionBy(manifest.LOAD, "_batch_id").parquet(lake.bronze)
    first, second, third = steps
    brought = first.where("rows_loaded > 0").select("_batch_id", F.lit(1).cast("bigint").alias("brought_by"), F.col("rows_loaded").alias("row_count"), F.col("files_loaded").alias("files"))
    brought = brought.union(second.where("rows_loaded > 0").select("_batch_id", F.lit(2).cast("bigint"), "rows_loaded", "files_loaded"))
    visible = manifest.landed(spark, book, lake.bronze, list(book.newest())).groupBy("_batch_id").agg(F.count(F.lit(1)).alias("visible_rows"))
    told = third.select("_batch_id", F.col("rows_loaded").alias("loaded_again"), ((F.col("files_already_loaded") == F.col("files_before")) & F.col("already_loaded")).alias("known_by_then"))
    return brought.join(told, "_batch_id").join(visible, "_batch_id")


_EVENT_TEXT = "(SELECT strftime(ts, '%Y-%m') AS _batch_id, event_id % 50 = 0 AS bad FROM events) e"


@register("bad_record_modes", (
    "SELECT 'abort' AS on_error, _batch_id, CAST(0 AS BIGINT) AS rows_loaded, count(*) FILTER (WHERE bad) AS error_rows, CAST(0 AS BIGINT) AS visible_rows, CAST(0 AS BIGINT) AS quarantined, true AS stopped"
    f" FROM {_EVENT_TEXT} GROUP BY 2 UNION ALL SELECT 'quarantine', _batch_id, count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE bad), count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE bad), true"
    f" FROM {_EVENT_TEXT} GROUP BY 2"))
def _bad_records(spark, sf_dir):
    """Text files with planted bad records: one mode stops with nothing loaded, the other sets the bad ones apart.

    Good and bad rows are counted by the write itself; the load gate stops a batch with error rows in both modes.
    """
    root = scratch_path(spark, "bad-records")
    events = inputs.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    line = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "value": oops'))).otherwise(F.to_json(F.struct(*events.columns)))
    lines = events.select(line.alias("value"), F.date_format("ts", "yyyy-MM").alias("_batch_id"))
    with unsorted_writes(spark):
        lines.hint("rebalance", F.col("_batch_id")).write.partitionBy("_batch_id").text(f"{root}/in")
    out = None
    for mode in ("abort", "quarantine"):
        lake = Lake(f"{root}/{mode}")
        book, stopped = book_of(spark, lake), False
        try:
            manifest.load_files(spark, book, lake.bronze, f"{root}/in", events.schema, _batch_of_file(), "*.txt", "json", mode)
        except DataQualityError:
            stopped = True
        told = materialise(book.reconcile(0), "told")
        if mode == "quarantine":
            try:
                bronze.require_load(told, told.agg(F.min("_batch_id")).first()[0])
            except DataQualityError:
                stopped = True
        all_rows = tables.read_table(spark, lake.bronze).where(F.col(manifest.LOAD).isin(book.loads_of([r["_batch_id"] for r in told.select("_batch_id").collect()])))
        seen = all_rows.groupBy("_batch_id").agg(F.count_if(F.col(manifest.REJECT).isNull()).alias("visible_rows"), F.count_if(F.col(manifest.REJECT).isNotNull()).alias("quarantined"))
        part = told.select(F.lit(mode).alias("on_error"), "_batch_id", "rows_loaded", "error_rows").join(seen, "_batch_id", "left").na.fill(0)
        part = part.select("on_error", "_batch_id", "rows_loaded", "error_rows", "visible_rows", "quarantined", F.lit(stopped).alias("stopped"))
        out = part if out is None else out.union(part)
    return out


@register("watermark_batches", oracle.sql(
    "SELECT _batch_id, count(*) AS row_count FROM raw WHERE _batch_id > (SELECT max(_batch_id) FROM raw WHERE _batch_id < '2025-03')"
    " GROUP BY 1", "raw"))
def _watermark(spark, sf_dir):
    """Rows beyond the newest loaded batch, by scalar subquery."""
    raw = inputs.raw_trips(spark, sf_dir)
    target = raw.filter(F.col("_batch_id") < "2025-03")
    return bronze.newer_than_watermark(raw, target).groupBy("_batch_id").agg(F.count(F.lit(1)).alias("row_count"))


@register("missing_months", oracle.sql(
    ", r AS (SELECT max(tpep_pickup_datetime) AS newest FROM raw), w AS (SELECT strftime(unnest(generate_series("
    " CAST(date_trunc('month', newest) - INTERVAL 5 MONTH AS TIMESTAMP), CAST(date_trunc('month', newest) AS TIMESTAMP), INTERVAL 1 MONTH)), '%Y-%m') AS batch_month FROM r)"
    " SELECT batch_month FROM w WHERE batch_month NOT IN (SELECT _batch_id FROM raw WHERE _batch_id <> '2025-02')", "raw"))
def _missing(spark, sf_dir):
    """Six newest publishable months of the newest trip's run that storage lacks."""
    raw = inputs.raw_trips(spark, sf_dir)
    run = raw.agg(F.add_months(F.to_date(F.max("tpep_pickup_datetime")), months.PUBLICATION_LAG).alias("run_date"))
    window = months.rolling_window(run, "run_date")
    return months.missing_months(window, raw.filter(F.col("_batch_id") != "2025-02")).select("batch_month")


@register("backfill_months", oracle.sql(
    ", b AS (SELECT min(tpep_pickup_datetime) AS lo, max(tpep_pickup_datetime) AS hi FROM raw),"
    " m AS (SELECT strftime(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP),"
    " CAST(date_trunc('month', hi) - INTERVAL 3 MONTH AS TIMESTAMP), INTERVAL 1 MONTH)), '%Y-%m') AS batch_month FROM b)"
    " SELECT batch_month, count(raw._batch_id) AS row_count FROM m LEFT JOIN raw ON _batch_id = batch_month GROUP BY 1", "raw"))
def _backfill(spark, sf_dir):
    """Months from the first trip up to the publication cutoff, with the rows stored for each."""
    raw = inputs.raw_trips(spark, sf_dir)
    bounds = raw.agg(F.min("tpep_pickup_datetime").cast("date").alias("first"), F.max("tpep_pickup_datetime").cast("date").alias("run_date"))
    wanted = months.backfill_months(bounds, "first", "run_date")
    stored = raw.groupBy(F.col("_batch_id").alias("batch_month")).agg(F.count(F.lit(1)).alias("row_count"))
    return wanted.join(stored, "batch_month", "left").na.fill(0, ["row_count"])


@register("zone_seed", oracle.sql(
    "SELECT CAST(LocationID AS BIGINT) AS LocationID, Borough, Zone, service_zone FROM zones", "zones"))
def _seed(spark, sf_dir):
    """Dimension written as CSV and loaded with declared types."""
    path = scratch_path(spark, "seed")
    inputs.zones(spark, sf_dir).write.option("header", True).csv(path)
    return seeds.read_seed(spark, path)


def _daily_table(spark, sf_dir, label):
    path = scratch_path(spark, label)
    tables.replace_partitions(gold.with_month(daily_of(spark, sf_dir), "pickup_date", MONTH), path, MONTH)
    return path


def _month_totals(df):
    return df.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("trip_count").alias("trip_count"),
        round_half_up(exact_sum("total_revenue"), 2).alias("total_revenue"))


def _month_sql(source: str) -> str:
    return (
        f"SELECT strftime(pickup_date, '%Y-%m') AS {MONTH}, count(*) AS row_count, CAST(sum(trip_count) AS BIGINT) AS trip_count,"
        f" {half_up(total('total_revenue'), 2)} AS total_revenue FROM {source} GROUP BY 1"
    )


@register("delete_where", oracle.sql(
    _month_sql("(SELECT * FROM daily WHERE NOT (pickup_date >= DATE '2024-05-10' AND pickup_date < DATE '2024-07-01'))"), "daily"))
def _delete(spark, sf_dir):
    """Predicate delete across a month that keeps rows and one that loses all."""
    path = _daily_table(spark, sf_dir, "delete")
    gone = (F.col("pickup_date") >= F.lit(date(2024, 5, 10))) & (F.col("pickup_date") < F.lit(date(2024, 7, 1)))
    tables.delete_where(spark, path, gone, MONTH)
    return _month_totals(tables.read_table(spark, path))


_UPSERT = oracle.sql(
    _month_sql("(SELECT pickup_date, trip_count, CASE WHEN pickup_borough = 'Queens' AND pickup_date >= DATE '2025-03-15'"
               " THEN total_revenue + 10.0E0 ELSE total_revenue END AS total_revenue FROM daily)"), "daily")


def _change_set(spark, sf_dir):
    """A daily table that lacks two months, and corrected and new rows for it."""
    full = gold.with_month(daily_of(spark, sf_dir), "pickup_date", MONTH)
    full = materialise(full, "daily")
    corrected = full.filter((F.col("pickup_borough") == "Queens") & (F.col("pickup_date") >= F.lit(date(2025, 3, 15))))
    change = corrected.withColumn("total_revenue", F.col("total_revenue") + F.lit(10.0)).unionByName(
        full.filter((F.col(MONTH) >= "2025-05") & (F.col("pickup_borough") != "Queens")))
    return full.filter(F.col(MONTH) < "2025-05"), change


@register("upsert_daily", _UPSERT)
def _upsert(spark, sf_dir):
    """A table that lacks two months receives corrected and new rows by key."""
    old, change = _change_set(spark, sf_dir)
    path = scratch_path(spark, "upsert-target")
    tables.replace_partitions(old, path, MONTH)
    tables.upsert(spark, path, change, ["fct_id"], MONTH)
    return _month_totals(tables.read_table(spark, path))


@register("upsert_bucketed", _UPSERT)
def _upsert_bucketed(spark, sf_dir):
    """The same merge into a table bucketed and sorted by its key; the old rows are not shuffled."""
    old, change = _change_set(spark, sf_dir)
    path = scratch_path(spark, "upsert-bucketed")
    table = BucketedTable(spark, f"daily_{path[-32:]}", path, ("fct_id",), MONTH, 8)
    table.register(old.schema)
    table.replace(old)
    table.upsert(change)
    return _month_totals(table.read())


@register("rerun_replaces_run", oracle.sql(
    "SELECT strftime(pickup_hour, '%Y-%m') AS forecast_month, CASE WHEN pickup_hour >= TIMESTAMP '2025-05-01 00:00:00' THEN '2025-08-06'"
    " ELSE '2025-06-05' END AS run_date, count(*) AS row_count FROM (SELECT pickup_hour, pu_location_id FROM hourly"
    " WHERE pickup_hour >= TIMESTAMP '2025-04-01 00:00:00' GROUP BY 1, 2) GROUP BY 1, 2", "hourly"))
def _rerun(spark, sf_dir):
    """Scoring the same month twice leaves one set of rows, that of the newer run."""
    path = scratch_path(spark, "rerun")
    demand = hourly_of(spark, sf_dir).filter(F.col("pickup_hour") >= F.lit("2025-04-01 00:00:00").cast("timestamp_ntz"))
    rows = materialise(
        demand.groupBy("pickup_hour", "pu_location_id").agg(F.sum("trip_count").cast("double").alias("predicted_trip_count"))
        .withColumn("forecast_month", month_text("pickup_hour")), "demand")
    april, later = F.col("forecast_month") == "2025-04", F.col("forecast_month") >= "2025-05"
    for part, run in ((april, "2025-06-05"), (later, "2025-08-05"), (later, "2025-08-06"), (later, "2025-08-06")):
        tables.replace_run(spark, path, rows.filter(part).withColumn("_run_date", F.lit(run).cast("date")), "_run_date", "forecast_month")
    out = tables.read_table(spark, path)
    return out.groupBy("forecast_month", F.col("_run_date").alias("run_date")).agg(F.count(F.lit(1)).alias("row_count"))


@register("typed_append", oracle.sql(
    "SELECT " + DT.format("anomaly_date") + ", count(*) AS row_count, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM"
    " (SELECT pickup_date AS anomaly_date, trip_count FROM daily UNION ALL SELECT pickup_date, trip_count FROM daily)"
    " GROUP BY anomaly_date", "daily"))
def _append(spark, sf_dir):
    """Typed insert with a required-column check, appended twice to an overwritten table."""
    path = scratch_path(spark, "append")
    rows = materialise(
        daily_of(spark, sf_dir).select(
            F.col("pickup_date").alias("anomaly_date"), "pu_location_id", "pickup_borough", "trip_count",
            F.lit(0.0).alias("z_score"), F.lit(0.0).alias("revenue_z_score"), F.lit(False).alias("is_anomaly"),
            F.lit("2025-08-05 00:00:00").alias("_scored_at"),
        ), "rows")
    tables.append(rows, path, tables.ANOMALY_SCHEMA, overwrite=True)
    tables.append(rows, path, tables.ANOMALY_SCHEMA, overwrite=True)
    tables.append(rows, path, tables.ANOMALY_SCHEMA)
    out = tables.read_table(spark, path, tables.ANOMALY_SCHEMA)
    return out.groupBy("anomaly_date").agg(F.count(F.lit(1)).alias("row_count"), F.sum("trip_count").alias("trip_count"))


@register("key_of_trip", oracle.sql(
    "SELECT trip_id, count(*) AS copies FROM typed GROUP BY trip_id HAVING count(*) > 1", "typed"))
def _keys(spark, sf_dir):
    """Surrogate keys that occur more than once before de-duplication."""
    return typed(spark, sf_dir).groupBy("trip_id").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
