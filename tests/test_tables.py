"""Sources, sinks, monthly runs and streams."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from faremill.operators.quality import DataQualityError
from faremill.plans import catalog, forecast, inputs
from faremill.plans.monthly import Lake, run_month
from faremill.schema import ZONE_SCHEMA
from faremill.session import materialise, scratch_path
from faremill.sources import bronze, months, seeds, tables
from faremill.streaming import ingest


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, month string, v double")


def content(spark, path):
    return sorted((r.k, r.month, r.v) for r in tables.read_table(spark, path).collect())


def test_upsert_touches_only_its_partitions(spark):
    path = scratch_path(spark, "t")
    tables.upsert(spark, path, frame(spark, [(1, "2024-01", 1.0), (2, "2024-01", 2.0), (3, "2024-02", 3.0)]), ["k"], "month")
    feb = [f for f in spark.read.parquet(path).inputFiles() if "month=2024-02" in f]
    assert tables.upsert(spark, path, frame(spark, [(2, "2024-01", 20.0), (4, "2024-01", 4.0)]), ["k"], "month") == ["2024-01"]
    assert content(spark, path) == [(1, "2024-01", 1.0), (2, "2024-01", 20.0), (3, "2024-02", 3.0), (4, "2024-01", 4.0)]
    assert [f for f in spark.read.parquet(path).inputFiles() if "month=2024-02" in f] == feb
    tables.upsert(spark, path, frame(spark, [(2, "2024-01", 20.0), (4, "2024-01", 4.0)]), ["k"], "month")
    assert len(content(spark, path)) == 4


def test_null_keys_never_match(spark):
    old, new = frame(spark, [(None, "2024-01", 1.0), (1, "2024-01", 1.0)]), frame(spark, [(None, "2024-01", 2.0)])
    assert tables.merged(old, new, ["k"]).count() == 3


def test_delete_where(spark):
    path = scratch_path(spark, "t")
    tables.delete_where(spark, path, F.lit(True), "month")  # no table yet
    tables.replace_partitions(frame(spark, [(1, "2024-01", 1.0), (2, "2024-01", None), (3, "2024-02", 3.0)]), path, "month")
    tables.delete_where(spark, path, F.col("v") > 0, "month")
    assert content(spark, path) == [(2, "2024-01", None)]


def test_typed_insert_requires_columns(spark):
    rows = frame(spark, [(1, "2024-01", 1.0)])
    with pytest.raises(ValueError, match="pickup_hour"):
        tables.append(rows, scratch_path(spark, "t"), tables.FORECAST_SCHEMA)


def test_cache_builds_once(spark):
    path, calls = scratch_path(spark, "t"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert tables.cached(spark, path, build).count() == tables.cached(spark, path, build).count() == 3 and calls == [1]


def test_months(spark):
    assert months.batch_month(date(2026, 4, 5)) == "2026-02" and months.batch_month(date(2026, 1, 31)) == "2025-11"
    runs = spark.createDataFrame([(date(2026, 6, 1),)], "d date")
    window = months.rolling_window(runs, "d")
    assert sorted(r.batch_month for r in window.collect()) == ["2025-11", "2025-12", "2026-01", "2026-02", "2026-03", "2026-04"]
    stored = spark.createDataFrame([("2026-01",), ("2026-04",)], "_batch_id string")
    assert months.missing_months(window, stored).count() == 4
    span = spark.createDataFrame([(date(2024, 1, 1), date(2024, 5, 20)), (date(2024, 5, 1), date(2024, 5, 20))], "f date, d date")
    assert sorted(r.batch_month for r in months.backfill_months(span, "f", "d").collect()) == ["2024-01", "2024-02"]
    row = runs.select(months.batch_month_column(F.col("d")).alias("m")).first()
    assert row.m == "2026-04"


def batches(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "_batch_id string")


def test_late_batch_modes(spark):
    raw, target = batches(spark, "2024-01", "2024-02", "2024-03"), batches(spark, "2024-01", "2024-03")
    assert bronze.newer_than_watermark(raw, target).count() == 0
    assert [r[0] for r in bronze.rows_of_unseen(raw, target).collect()] == ["2024-02"]
    assert bronze.newer_than_watermark(raw, target.limit(0)).count() == 3
    assert [r[0] for r in bronze.unseen(raw, target).collect()] == ["2024-02"]


def test_load_gate(spark):
    table = bronze.reconcile(batches(spark, "a", "b"), batches(spark, "a", "a", "b"))
    bronze.require_load(table, "a")
    bronze.require_load(table, "b")  # nothing new, but present
    with pytest.raises(DataQualityError):
        bronze.require_load(table, "c")
    with pytest.raises(DataQualityError):
        bronze.require_load(table, "a", error_rows=1)


def test_seed_types_and_literals(spark, tmp_path):
    file = tmp_path / "zones.csv"
    file.write_text('LocationID,Borough,Zone,service_zone\n264,Unknown,N/A,N/A\n1,EWR,"Newark, Airport",EWR\n')
    rows = {r.LocationID: r for r in seeds.read_seed(spark, str(file)).collect()}
    assert rows[264].Zone == "N/A" and rows[1].Zone == "Newark, Airport"
    file.write_text("LocationID,Borough,Zone,service_zone\nx,Unknown,N/A,N/A\n")
    with pytest.raises(Exception):
        seeds.read_seed(spark, str(file)).collect()


def test_corrupt_file_stops_the_scan(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "trips_2024-01.parquet"))
    (tmp_path / "trips_2024-02.parquet").write_bytes(b"not parquet")
    assert bronze.scan_months(spark, str(tmp_path), ["2024-01"]).count() == 3
    with pytest.raises(Exception):
        bronze.scan_months(spark, str(tmp_path), ["2024-01", "2024-02"], schema=spark.range(1).schema).collect()


def test_month_scan_reads_only_its_files(spark, tmp_path):
    for m in ("2024-01", "2024-02"):
        spark.range(3).write.parquet(str(tmp_path / f"trips_{m}.parquet"))
    df = bronze.scan_months(spark, str(tmp_path), ["2024-02"])
    assert df.count() == 3 and all("2024-02" in f for f in df.inputFiles())
    assert all("trips_2024-02" in r._source_file for r in bronze.rows_per_file(df).collect())


def test_monthly_runs_in_any_order_equal_one_run(spark, sf_dir):
    raw = materialise(inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") < "2024-05"), "raw")
    zones = materialise(inputs.zones(spark, sf_dir), "zones")
    results = []
    for order in (["2024-04", "2024-02", "2024-03", "2024-01"], None):
        lake = Lake(scratch_path(spark, "lake"))
        seen = F.lit(False)
        for m in order or []:
            seen = seen | (F.col("_batch_id") == m)
            assert run_month(spark, lake, raw.filter(seen), zones) == [m]
        if not order:
            run_month(spark, lake, raw, zones)
        assert run_month(spark, lake, raw, zones) == []  # nothing pending
        results.append([sorted(map(str, tables.read_table(spark, p).collect())) for p in (lake.silver, lake.hourly, lake.daily)])
    assert results[0] == results[1] and results[0][0]


def test_a_failed_gate_is_taken_up_by_the_next_run(spark, sf_dir, monkeypatch):
    from faremill.operators import quality

    raw = materialise(inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") < "2024-03"), "raw")
    zones, lake, whole = materialise(inputs.zones(spark, sf_dir), "zones"), Lake(scratch_path(spark, "lake")), Lake(scratch_path(spark, "lake"))

    def stop(*_):
        raise DataQualityError("stopped")

    with monkeypatch.context() as m:
        m.setattr(quality, "require_clean", stop)
        with pytest.raises(DataQualityError):
            run_month(spark, lake, raw, zones)
    assert not tables.exists(spark, lake.hourly)
    assert run_month(spark, lake, raw, zones) == ["2024-01", "2024-02"] and run_month(spark, lake, raw, zones) == []
    run_month(spark, whole, raw, zones)
    for own, other in ((lake.hourly, whole.hourly), (lake.daily, whole.daily)):
        assert sorted(map(str, tables.read_table(spark, own).collect())) == sorted(map(str, tables.read_table(spark, other).collect()))


def test_a_second_file_lands_and_an_emptied_month_goes(spark, sf_dir):
    raw = materialise(inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") < "2024-03"), "raw")
    zones, lake = materialise(inputs.zones(spark, sf_dir), "zones"), Lake(scratch_path(spark, "lake"))
    first = raw.filter("_ingested_at = TIMESTAMP_NTZ '2025-07-01 00:00:00'")
    more = raw.exceptAll(first).withColumn("_source_file", F.lit("more.parquet"))
    assert run_month(spark, lake, first, zones, expected=["2024-01"]) == ["2024-01", "2024-02"]
    n = tables.read_table(spark, lake.bronze).count()
    assert more.count() and run_month(spark, lake, first.unionByName(more), zones) == [r[0] for r in more.select("_batch_id").distinct().orderBy("_batch_id").collect()]
    assert tables.read_table(spark, lake.bronze).count() == n + more.count()
    whole = Lake(scratch_path(spark, "lake"))
    run_month(spark, whole, first.unionByName(more), zones)
    for own, other in ((lake.silver, whole.silver), (lake.hourly, whole.hourly), (lake.daily, whole.daily)):
        assert sorted(map(str, tables.read_table(spark, own).collect())) == sorted(map(str, tables.read_table(spark, other).collect()))
    back = first.filter("_batch_id = '2024-02'").withColumns(
        {"fare_amount": F.lit(-1.0), "_source_file": F.lit("back.parquet"), "_ingested_at": F.expr("_ingested_at + INTERVAL 9 DAY")})
    assert run_month(spark, lake, back, zones) == ["2024-02"] and run_month(spark, lake, back, zones) == []
    for path, column in ((lake.silver, "_batch_id"), (lake.hourly, "pickup_month"), (lake.daily, "pickup_month")):
        assert tables.touched_values(tables.read_table(spark, path), column) == ["2024-01"]


def test_a_load_without_rows_or_batches_stops(spark, sf_dir):
    raw = materialise(inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") == "2024-01"), "raw")
    zones, lake = materialise(inputs.zones(spark, sf_dir), "zones"), Lake(scratch_path(spark, "lake"))
    assert run_month(spark, lake, raw.limit(0), zones) == []
    with pytest.raises(Exception, match="_batch_id"):
        run_month(spark, lake, raw.withColumn("_batch_id", F.lit(None).cast("string")), zones)
    with pytest.raises(DataQualityError, match="2024-02"):
        run_month(spark, lake, raw, zones, expected=["2024-01", "2024-02"])
    assert run_month(spark, lake, raw, zones, expected=["2024-01"]) == ["2024-01"]


def test_file_reconciliation(spark):
    schema = "_batch_id string, _source_file string"
    rows = [("a", "f1"), ("a", "f1"), ("a", "f2"), ("b", "f3")]
    before, after = (bronze.file_ledger(spark.createDataFrame(r, schema)) for r in (rows[:2], rows))
    got = {r._batch_id: (r.rows_loaded, r.files_loaded, r.files_after, r.already_loaded) for r in bronze.reconcile_files(before, after).collect()}
    assert got == {"a": (1, 1, 2, False), "b": (1, 1, 1, False)}


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from faremill.session import scratch_root

    none = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: none, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(SimpleNamespace(conf=none, sparkContext=context))


def test_watermark_mode_skips_a_late_batch(spark, sf_dir):
    raw = materialise(inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") < "2024-03"), "raw")
    zones, lake = inputs.zones(spark, sf_dir), Lake(scratch_path(spark, "lake"))
    assert run_month(spark, lake, raw.filter("_batch_id = '2024-02'"), zones, mode="watermark") == ["2024-02"]
    assert run_month(spark, lake, raw, zones, mode="watermark") == []
    assert run_month(spark, lake, raw, zones) == ["2024-01"]


def test_file_stream_loads_each_file_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = frame(spark, []).schema
    for lot in ([(1, "a", 1.0)], [(2, "b", 2.0)], []):
        if lot:
            frame(spark, lot).write.mode("append").parquet(source)
        ingest.land_available(ingest.file_stream(spark, source, schema), out, mark)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2]


def test_scoring_twice_keeps_one_set(spark):
    path = scratch_path(spark, "f")
    rows = [(datetime(2025, 6, d, 1), 7, "Queens", float(d), "1") for d in (1, 2, 3)]
    base = spark.createDataFrame(rows, "pickup_hour timestamp_ntz, pu_location_id int, pickup_borough string, predicted_trip_count double, model_version string")
    for run in (date(2025, 8, 5), date(2025, 8, 6)):
        out = base.withColumn("_run_date", F.lit(run)).withColumn("forecast_month", F.lit("2025-06"))
        tables.replace_run(spark, path, out, "_run_date", "forecast_month")
    got = tables.read_table(spark, path).collect()
    assert len(got) == 3 and {r._run_date for r in got} == {date(2025, 8, 6)}


def test_scoring_needs_a_production_model(spark, sf_dir):
    from faremill.operators.registry import ModelRegistry

    with pytest.raises(RuntimeError):
        forecast.score(spark, catalog.hourly_of(spark, sf_dir), date(2025, 8, 5), ModelRegistry(spark, scratch_path(spark, "r")), scratch_path(spark, "f"))


def test_zone_schema_names():
    assert ZONE_SCHEMA.fieldNames() == ["LocationID", "Borough", "Zone", "service_zone"]


def test_scratch_follows_the_cluster_setting(spark):
    from faremill.session import scratch_root

    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_bucketed_merge_never_shuffles_the_old_side(spark, tmp_path):
    from faremill.sources.bucketed import BucketedTable

    path = scratch_path(spark, "bucketed")
    schema = frame(spark, []).schema
    table = BucketedTable(spark, f"t_{path[-32:]}", path, ("k",), "month", 4)
    table.register(schema)
    assert table.upsert(frame(spark, [(i, f"2024-0{1 + i % 3}", float(i)) for i in range(60)] + [(None, "2024-01", -1.0)])) == ["2024-01", "2024-02", "2024-03"]
    february = {f for f in table.read().inputFiles() if "month=2024-02" in f}
    change = frame(spark, [(0, "2024-01", 100.0), (2, "2024-03", 102.0), (90, "2024-01", 90.0)])
    plan = table.untouched(change, ["2024-01", "2024-03"])._jdf.queryExecution().executedPlan().toString()
    old_side = plan[: plan.index("Exchange")] if "Exchange" in plan else plan
    assert "FileScan" in old_side and "SelectedBucketsCount: 4 out of 4" in old_side and plan.count("Exchange") <= 2
    assert table.upsert(change) == ["2024-01", "2024-03"]
    got = {(r.k, r.month): r.v for r in table.read().collect()}
    want = {(i, f"2024-0{1 + i % 3}"): float(i) for i in range(60)} | {(None, "2024-01"): -1.0, (0, "2024-01"): 100.0, (2, "2024-03"): 102.0, (90, "2024-01"): 90.0}
    assert got == want and {f for f in table.read().inputFiles() if "month=2024-02" in f} == february
    again = BucketedTable(spark, f"{table.name}_again", path, ("k",), "month", 4)
    again.register(schema)
    assert {(r.k, r.month): r.v for r in again.read().collect()} == want


def test_cache_follows_its_input(spark):
    source, path = scratch_path(spark, "source"), scratch_path(spark, "cache")
    sums = []
    for v in (1.0, 2.0, None):
        if v:
            frame(spark, [(1, "2024-01", v)]).write.mode("overwrite").parquet(source)
        rows = spark.read.parquet(source)
        sums.append(tables.cached(spark, path, lambda rows=rows: rows, tables.version_of(rows)).first().v)
    assert sums == [1.0, 2.0, 2.0]
