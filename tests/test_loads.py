"""Load manifest, counted writes, bad records and shredded variants."""

import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from faremill.operators.quality import DataQualityError
from faremill.plans import inputs
from faremill.plans.monthly import Lake, book_of, run_files, run_month
from faremill.session import materialise, scratch_path
from faremill.sources import bronze, manifest, tables

SCHEMA = "k long, v string"


def put(folder, name, keys):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table({"k": pa.array(keys, pa.int64()), "v": [str(k) for k in keys]}), f"{folder}/{name}.parquet")


def load(spark, lake, folder, **how):
    from pyspark.sql.types import StructType

    batch = F.regexp_extract("file", r"(\d{4}-\d{2})", 1)
    rows = manifest.load_files(spark, book_of(spark, lake), lake.bronze, folder, StructType.fromDDL(SCHEMA), batch, **how)
    return {r["_batch_id"]: r.asDict() for r in rows.collect()}


def seen(spark, lake, *months):
    rows = manifest.landed(spark, book_of(spark, lake), lake.bronze, months)
    return sorted(r["k"] for r in rows.collect())


def test_each_file_loads_once_and_a_changed_one_is_reported(spark, tmp_path):
    folder, lake = str(tmp_path / "in"), Lake(scratch_path(spark, "lake"))
    put(folder, "t_2024-01", [1, 2])
    put(folder, "t_2024-02", [3])
    first = load(spark, lake, folder)
    assert (first["2024-01"]["rows_loaded"], first["2024-02"]["files_loaded"], first["2024-01"]["rows_before"]) == (2, 1, 0)
    put(folder, "t_2024-01b", [4, 5, 6])
    put(folder, "t_2024-02", [7, 8, 9, 10])
    second = load(spark, lake, folder)
    assert (second["2024-01"]["rows_before"], second["2024-01"]["rows_loaded"], second["2024-01"]["files_already_loaded"]) == (2, 3, 1)
    assert (second["2024-02"]["files_changed"], second["2024-02"]["rows_loaded"], second["2024-02"]["already_loaded"]) == (1, 0, True)
    assert seen(spark, lake, "2024-01", "2024-02") == [1, 2, 3, 4, 5, 6]
    states = {(r["file"].rsplit("/", 1)[1], r["state"]) for r in book_of(spark, lake).entries().collect()}
    assert ("t_2024-02.parquet", manifest.CHANGED) in states and ("t_2024-02.parquet", manifest.LOADED) in states


def test_an_unreadable_file_commits_nothing(spark, tmp_path):
    folder, lake = str(tmp_path / "in"), Lake(scratch_path(spark, "lake"))
    put(folder, "t_2024-01", [1, 2])
    (tmp_path / "in" / "t_2024-02.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        load(spark, lake, folder)
    assert book_of(spark, lake).newest() == {}
    put(folder, "t_2024-02", [3])
    assert load(spark, lake, folder)["2024-01"]["rows_loaded"] == 2 and seen(spark, lake, "2024-01", "2024-02") == [1, 2, 3]


def test_bad_records(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "t_2024-01.json").write_text('{"k": 1, "v": "a"}\n{"k": oops\n{"k": "x", "v": "b"}\n')
    (folder / "t_2024-02.json").write_text('{"k": 2, "v": "c"}\n')
    lake = Lake(scratch_path(spark, "lake"))
    with pytest.raises(DataQualityError, match="2 rows of 1 files"):
        load(spark, lake, str(folder), file_format="json")
    assert {(r["state"], r["error_rows"]) for r in book_of(spark, lake).entries().collect()} == {(manifest.FAILED, 2), (manifest.FAILED, 0)}
    assert seen(spark, lake, "2024-01", "2024-02") == []
    told = load(spark, lake, str(folder), file_format="json", on_error="quarantine")
    assert (told["2024-01"]["rows_loaded"], told["2024-01"]["error_rows"]) == (1, 2) and seen(spark, lake, "2024-01", "2024-02") == [1, 2]
    bad = tables.read_table(spark, lake.bronze).where(F.col(manifest.REJECT).isNotNull() & F.col(manifest.LOAD).isin(book_of(spark, lake).loads_of(["2024-01"])))
    assert sorted(r[manifest.REJECT] for r in bad.collect()) == ['{"k": "x", "v": "b"}', '{"k": oops']
    rows = book_of(spark, lake).reconcile(0)
    with pytest.raises(DataQualityError, match="rows failed"):
        bronze.require_load(rows, "2024-01")
    bronze.require_load(rows, "2024-02")
    with pytest.raises(ValueError):
        load(spark, lake, str(folder), on_error="ignore")


def test_many_files_become_several_loads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "MOST_FILES", 2)
    folder, lake = str(tmp_path / "in"), Lake(scratch_path(spark, "lake"))
    for i in range(5):
        put(folder, f"t_2024-0{i + 1}", [i] * (i + 1))
    told = load(spark, lake, folder)
    assert {b: r["rows_loaded"] for b, r in told.items()} == {f"2024-0{i + 1}": i + 1 for i in range(5)}
    assert book_of(spark, lake).entries().select("load").distinct().count() == 3


def test_a_run_never_reads_finished_months(spark, sf_dir):
    """Bronze, silver and gold of a finished month are made unreadable: later runs don't notice."""
    raw = materialise(inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") < "2024-04"), "raw")
    zones, lake = materialise(inputs.zones(spark, sf_dir), "zones"), Lake(scratch_path(spark, "lake"))
    assert run_month(spark, lake, raw.filter("_batch_id < '2024-03'"), zones) == ["2024-01", "2024-02"]
    root = lake.root.removeprefix("file:")
    spoilt = [f for f in glob.glob(f"{root}/bronze/trips/*/_batch_id=2024-01/*.parquet")]
    assert spoilt
    for f in spoilt:
        with open(f, "wb") as out:
            out.write(b"gone")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert run_month(spark, lake, raw, zones, expected=["2024-03"]) == ["2024-03"]
    assert run_month(spark, lake, raw, zones) == []


def test_a_crashed_load_is_seen_by_nobody(spark, sf_dir, monkeypatch):
    raw = materialise(inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") == "2024-01"), "raw")
    zones, lake = materialise(inputs.zones(spark, sf_dir), "zones"), Lake(scratch_path(spark, "lake"))

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(manifest.Manifest, "commit_written", crash)
        with pytest.raises(RuntimeError):
            run_month(spark, lake, raw, zones)
    assert tables.exists(spark, lake.bronze) and book_of(spark, lake).newest() == {}
    assert run_month(spark, lake, raw, zones) == ["2024-01"]
    assert manifest.landed(spark, book_of(spark, lake), lake.bronze, ["2024-01"]).count() == raw.count()


def test_files_to_gold(spark, sf_dir, tmp_path):
    raw = inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") < "2024-03").drop("_source_file", "_ingested_at")
    raw.repartition(1).write.partitionBy("_batch_id").parquet(f"{tmp_path}/in")
    zones, lake = materialise(inputs.zones(spark, sf_dir), "zones"), Lake(scratch_path(spark, "lake"))
    batch = F.regexp_extract("file", r"_batch_id=([0-9-]+)", 1)
    how = dict(pattern="*.parquet", expected=["2024-02"])
    assert run_files(spark, lake, f"{tmp_path}/in", raw.drop("_batch_id").schema, batch, zones, **how) == ["2024-01", "2024-02"]
    assert run_files(spark, lake, f"{tmp_path}/in", raw.drop("_batch_id").schema, batch, zones, **how) == []
    assert tables.read_table(spark, lake.hourly).count() > 0


def test_counts_come_from_the_write(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, "b")], "k long, part string")
    path = scratch_path(spark, "t")
    got = manifest.write_observed(df, path, ("part",), {"rows": F.count(F.lit(1)), "nulls": F.count_if(F.col("k").isNull())})
    assert got == {"rows": 3, "nulls": 1} and spark.read.parquet(path).count() == 3
    assert manifest.write_observed(df.limit(0), path, ("part",), {"rows": F.count(F.lit(1))}) == {"rows": 0}


def test_shredded_variants_read_only_what_is_asked(spark):
    raw = spark.range(200).selectExpr(
        "id as a", "cast(id as string) as b", "id / 2.0D as c", "if(id % 10 = 0, null, id) as d", "timestamp_ntz '2024-01-01 00:00:00' as t", "'f' as _source_file", "'2024-01' as _batch_id"
    )
    path = scratch_path(spark, "variants")
    bronze.land_variants(raw, path, F.col("_batch_id"))
    read = spark.read.parquet(path).select(F.try_variant_get("raw_data", "$.a", "bigint").alias("a"), F.try_variant_get("raw_data", "$.c", "double").alias("c"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "raw_data:struct<0:bigint,1:double>" in plan.replace("\n", "")
    assert sorted(map(tuple, read.collect())) == [(i, i / 2) for i in range(200)]
    full = spark.read.parquet(path).select(F.try_variant_get("raw_data", "$.d", "bigint").alias("d"), F.try_variant_get("raw_data", "$.none", "string").alias("n"))
    assert sum(r["d"] is None for r in full.collect()) == 20 and {r["n"] for r in full.collect()} == {None}
    file = next(f for f in glob.glob(f"{path.removeprefix('file:')}/*/*.parquet"))
    assert any("typed_value" in c for c in pq.ParquetFile(file).schema.names)


def test_variants_of_changing_types_keep_their_values(spark):
    texts = ['{"x": %s, "y": {"z": [1, "two", null]}}' % (f'"{i}"' if i % 3 == 0 else i if i % 3 == 1 else "null") for i in range(60)]
    path = scratch_path(spark, "mixed")
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.parse_json("t").alias("v")).write.parquet(path)
    rows = spark.read.parquet(path).select("i", F.try_variant_get("v", "$.x", "string").alias("x"), F.try_variant_get("v", "$.y.z[1]", "string").alias("z")).collect()
    assert {r["i"]: r["x"] for r in rows} == {i: None if i % 3 == 2 else str(i) for i in range(60)} and {r["z"] for r in rows} == {"two"}


def test_a_run_leaves_no_scratch(spark, sf_dir):
    from faremill.session import scratch_root

    raw = materialise(inputs.raw_trips(spark, sf_dir).filter(F.col("_batch_id") == "2024-01"), "raw")
    zones, lake = materialise(inputs.zones(spark, sf_dir), "zones"), Lake(scratch_path(spark, "lake"))
    folder = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert run_month(spark, lake, raw, zones, expected=["2024-01"]) == ["2024-01"]
    assert set(os.listdir(folder)) - before == {os.path.basename(lake.root)} and tables.read_table(spark, lake.daily).count() > 0


def test_partitioned_writes_and_publishing_sort_and_shuffle_no_rows(spark, tmp_path, monkeypatch):
    """Rows go straight to their partition's file; a copy of a partitioned table is not shuffled; the setting is put back."""
    from pyspark.sql import DataFrameWriter

    setting, written, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def noted(self, path, *more, **how):
        written.append((int(spark.conf.get(setting, "0")), self._df._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, path, *more, **how)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    rows, before = spark.range(0, 4000, 1, 4).selectExpr("id AS k", "concat('2024-0', 1 + id % 3) AS m"), spark.conf.get(setting, "0")
    first, copy = str(tmp_path / "first"), str(tmp_path / "copy")
    assert manifest.write_observed(rows, first, ("m",), {"rows": F.count(F.lit(1))})["rows"] == 4000
    tables.replace_listed(spark, tables.read_table(spark, first), copy, "m", ["2024-01", "2024-02", "2024-03"], arranged=True)
    assert sorted(map(tuple, tables.read_table(spark, copy).collect())) == sorted(map(tuple, rows.collect()))
    assert len(written) == 2 and all(n > 3 and "Rebalance" not in plan for n, plan in written) and spark.conf.get(setting, "0") == before
