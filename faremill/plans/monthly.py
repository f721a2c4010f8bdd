"""Monthly load: bronze to silver to gold, with a gate after each layer."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold, quality, silver
from ..schema import TripRules
from ..session import materialise, scratch_path, scratch_scope
from ..sources import bronze, manifest, tables
from ..sources.manifest import Manifest

MONTH = "pickup_month"


@dataclass(frozen=True)
class Lake:
    """Table folders of one deployment."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/trips"

    @property
    def manifest(self) -> str:
        return f"{self.root}/bronze/manifest"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/trips"

    @property
    def hourly(self) -> str:
        return f"{self.root}/gold/revenue_hourly"

    @property
    def daily(self) -> str:
        return f"{self.root}/gold/revenue_daily"

    @property
    def marks(self) -> str:
        return f"{self.root}/runs/months"

    @property
    def winners(self) -> str:
        return f"{self.root}/stream/winners"

    @property
    def moments(self) -> str:
        return f"{self.root}/stream/moments"

    @property
    def forecast(self) -> str:
        return f"{self.root}/ml/demand_forecast"

    @property
    def impact(self) -> str:
        return f"{self.root}/ml/policy_impact"

    @property
    def monitoring(self) -> str:
        return f"{self.root}/ml/model_monitoring"

    @property
    def anomalies(self) -> str:
        return f"{self.root}/ml/anomalies"

    @property
    def models(self) -> str:
        return f"{self.root}/ml/registry"


def book_of(spark: SparkSession, lake: Lake) -> Manifest:
    return Manifest(spark, lake.manifest)


def land(spark: SparkSession, lake: Lake, raw: DataFrame) -> DataFrame:
    """Append load units (batch and file) that were never loaded; returns rows and files per batch before and after.

    The manifest says what was loaded: a second file of a loaded month lands, a file that was loaded does not, and
    no earlier row of bronze is read. A row without a batch stops the load before anything is committed.
    """
    return manifest.load_rows(spark, book_of(spark, lake), lake.bronze, raw)


def pending(spark: SparkSession, lake: Lake, mode: str = "missing_batches") -> dict[str, int]:
    """Months that have not passed every gate since their newest load, with that load's time.

    ``missing_batches`` also picks up a month that arrived late; ``watermark`` takes only months beyond
    the newest finished one. Months are table metadata: one short text each.
    """
    newest, closed = book_of(spark, lake).newest(), _closed(spark, lake)
    todo = {m: at for m, at in sorted(newest.items()) if closed.get(m, -1) < at}
    if mode == "watermark":
        last = max(closed, default="")
        return {m: at for m, at in todo.items() if m > last}
    if mode == "missing_batches":
        return todo
    raise ValueError(f"unknown mode {mode!r}")


def refresh_silver(spark: SparkSession, lake: Lake, months: list[str], rules: TripRules = TripRules()) -> None:
    """Clean whole months from all their files, test the result, then publish it.

    Copies of a trip are compared within their batch, so the result does not depend on which months a run
    takes together. A month whose rows are all rejected by now is emptied.
    """
    if not months:
        return
    source = manifest.landed(spark, book_of(spark, lake), lake.bronze, months)
    own = replace(rules, dedup_keys=("_batch_id", *rules.dedup_keys))
    # A trip's id follows from its columns and hardly compresses, so it is worked out after the last shuffle.
    kept = silver.build_silver(silver.typed_from_columns(source, own).drop("trip_id"), own)
    rows = _tested(kept, "silver", "trip_id", quality.SILVER_NOT_NULL, "_batch_id", lambda df: silver.with_trip_id(df, own))
    tables.replace_listed(spark, rows, lake.silver, "_batch_id", months, arranged=True)


def refresh_gold(spark: SparkSession, lake: Lake, zones: DataFrame, months: list[str], rules: TripRules = TripRules()) -> None:
    """Rebuild both facts for whole months; each is tested before it is published.

    A pickup month is one partition in every layer, so replacing the partitions equals a merge by key over
    complete months.
    """
    if not months:
        return
    trips = tables.read_table(spark, lake.silver).filter(F.col("_batch_id").isin(months))
    publish_facts(spark, lake, gold.build_hourly(trips, zones, rules), months)


def publish_facts(spark: SparkSession, lake: Lake, hourly: DataFrame, months: list[str]) -> None:
    """Test and publish the hourly rows of whole months, and the daily fact that follows from them."""
    hourly = _tested(gold.with_month(hourly, "pickup_hour", MONTH), "hourly", "fct_id", quality.HOURLY_NOT_NULL, MONTH)
    daily = _tested(gold.with_month(gold.build_daily(hourly.drop(MONTH)), "pickup_date", MONTH), "daily", "fct_id", quality.DAILY_NOT_NULL, MONTH)
    tables.replace_listed(spark, hourly, lake.hourly, MONTH, months, arranged=True)
    tables.replace_listed(spark, daily, lake.daily, MONTH, months, arranged=True)


def _tested(df: DataFrame, name: str, key: str, not_null: Sequence[str], partition_by: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Write a layer to scratch and pass it through its gate; returns the written rows.

    The NULL counts come from the write itself. Only the key column is read again, for its repeats. ``finish`` adds
    columns to the rows once they have been shuffled to their partition.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    nulls = {c: F.count_if(F.col(c).isNull()) for c in not_null}
    out = df.hint("rebalance", F.col(partition_by))
    out = finish(out) if finish else out
    counted = manifest.write_observed(out, path, (partition_by,), nulls)
    rows = spark.read.schema(out.schema).parquet(path)
    tests = spark.createDataFrame([(name, c, "not_null", counted[c]) for c in not_null], "table_name string, column_name string, check_name string, failures long")
    quality.require_clean(tests.unionByName(quality.unique_failures(rows, name, key)))
    return rows


def mark(spark: SparkSession, lake: Lake, months: dict[str, int]) -> None:
    """Note up to which load the layers of some months agree."""
    if months:
        rows = [(at, m) for m, at in months.items()]
        spark.createDataFrame(rows, "at long, batch string").coalesce(1).write.mode("append").parquet(lake.marks)


def _closed(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Of each month that passed every gate: the newest load that was in it then."""
    if not tables.exists(spark, lake.marks):
        return {}
    return {r["batch"]: r["at"] for r in tables.read_table(spark, lake.marks).groupBy("batch").agg(F.max("at").alias("at")).collect()}


def run_month(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame,
    zones: DataFrame,
    rules: TripRules = TripRules(),
    mode: str = "missing_batches",
    expected: Sequence[str] = (),
) -> list[str]:
    """One monthly run: land, check the load, then clean, test and publish layer by layer.

    ``expected`` names the months the run was started for; the run stops when one of them brought no row and
    held none. After its last gate a month is marked with the newest load it holds, so a run that a gate or a crash
    stopped in between is taken up by the next one, also when nothing new has landed. Returns the months published.
    """
    with scratch_scope(spark):
        return publish(spark, lake, land(spark, lake, raw), zones, rules, mode, expected)


def run_files(
    spark: SparkSession,
    lake: Lake,
    directory: str,
    schema: T.StructType,
    batch: Column,
    zones: DataFrame,
    rules: TripRules = TripRules(),
    mode: str = "missing_batches",
    expected: Sequence[str] = (),
    **source,
) -> list[str]:
    """One monthly run from a folder of files: those never loaded are counted while they land, then as run_month.

    ``batch`` names a file's month, ``source`` holds the options of :func:`manifest.load_files`.
    """
    with scratch_scope(spark):
        loaded = manifest.load_files(spark, book_of(spark, lake), lake.bronze, directory, schema, batch, **source)
        return publish(spark, lake, loaded, zones, rules, mode, expected)


def publish(spark: SparkSession, lake: Lake, loaded: DataFrame, zones: DataFrame, rules: TripRules, mode: str, expected: Sequence[str]) -> list[str]:
    """Check what a load brought, then rebuild, test and publish the pending months layer by layer."""
    if expected:
        loaded = materialise(loaded, "loaded")
        for month in expected:
            bronze.require_load(loaded, month)
    months = pending(spark, lake, mode)
    if months:
        refresh_silver(spark, lake, list(months), rules)
        refresh_gold(spark, lake, zones, list(months), rules)
        mark(spark, lake, months)
    return list(months)
