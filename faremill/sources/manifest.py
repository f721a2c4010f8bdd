"""Load manifest: an append-only table of the files that have been loaded, and loads that commit through it.

A load writes its rows below a folder of its own (``_load=...``) and counts them while writing. It becomes visible
by one appended manifest file that names its load units: readers take the rows of committed loads only, so a load
that crashed leaves nothing behind that anyone sees, and a rerun starts afresh. What a run has to load follows from
the manifest and a listing of the files; the rows of earlier loads are never counted again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import DataQualityError
from ..session import materialise, unsorted_writes
from . import tables

LOAD = "_load"
#: Text of a record that its format could not parse; NULL for good rows.
REJECT = "_corrupt_record"
#: Load unit: the file, within the batch its rows belong to.
UNIT = ("_batch_id", "_source_file")
#: Files that one write loads and counts; more files become more loads.
MOST_FILES = 200

LOADED, FAILED, CHANGED = "loaded", "failed", "changed"
_SCHEMA = "load string, batch string, file string, size long, modified long, rows long, error_rows long, state string, at long"


def new_load() -> tuple[str, int]:
    """A name for a load, and its time; names sort by time."""
    at = time.time_ns()
    return f"{at:020d}-{uuid.uuid4().hex[:8]}", at


def list_files(spark: SparkSession, directory: str, pattern: str | None = None) -> DataFrame:
    """(file, size, modified) of the files below ``directory``; their contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    meta = F.col("_metadata")
    return reader.load(directory).select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size"), F.unix_micros(meta["file_modification_time"]).alias("modified")
    )


def write_observed(df: DataFrame, path: str, partition_by: Sequence[str], metrics: dict[str, Column], mode: str = "append") -> dict:
    """Write ``df`` and return ``metrics``, counted by the write's own tasks."""
    seen = Observation()
    writer = df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with unsorted_writes(df.sparkSession):
        writer.partitionBy(*partition_by).parquet(path)
    return seen.get


@dataclass(frozen=True)
class Manifest:
    """The manifest at ``path``: a row a file and load."""

    spark: SparkSession
    path: str

    def entries(self) -> DataFrame:
        schema = T.StructType.fromDDL(_SCHEMA)
        if not tables.exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        rows = tables.read_table(self.spark, self.path, schema)
        # A replayed load notes its units again.
        last = rows.groupBy("load", "batch", "file").agg(F.max_by(F.struct(*schema.fieldNames()), "at").alias("last"))
        return last.select("last.*")

    def units(self) -> DataFrame:
        """Committed load units, named like the columns of bronze."""
        return self.entries().where(F.col("state") == LOADED).select(F.col("batch").alias(UNIT[0]), F.col("file").alias(UNIT[1])).distinct()

    def commit(self, rows: DataFrame) -> None:
        """Append entries as one file: they become visible together."""
        columns = T.StructType.fromDDL(_SCHEMA)
        rows.select(*[F.col(f.name).cast(f.dataType) for f in columns]).coalesce(1).write.mode("append").parquet(self.path)

    def commit_written(self, bronze: str, load: str, at: int) -> None:
        """Commit a load with the units and row counts of the files it has just written.

        Only the name column of this load's own files is read.
        """
        own = folders(self.spark, bronze, [load])
        per_unit = own.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("rows"))
        nothing = F.lit(None).cast("long")
        self.commit(
            per_unit.select(
                F.lit(load).alias("load"), F.col(UNIT[0]).alias("batch"), F.col(UNIT[1]).alias("file"), nothing.alias("size"), nothing.alias("modified"), "rows",
                F.lit(0).alias("error_rows"), F.lit(LOADED).alias("state"), F.lit(at).alias("at"),
            )
        )

    def compare(self, files: DataFrame) -> DataFrame:
        """``files`` (file, size, modified, batch) with status new, loaded or changed.

        A file is changed if its name was loaded with another size or modification time; units whose source
        did not tell them are taken as the same. A file whose load failed is new.
        """
        known = self.entries().where(F.col("state") == LOADED).groupBy("file").agg(F.max_by(F.struct("size", "modified"), "at").alias("last"))
        same = F.coalesce((F.col("last.size") == F.col("size")) & (F.col("last.modified") == F.col("modified")), F.lit(True))
        status = F.when(F.col("last").isNull(), "new").when(same, LOADED).otherwise(CHANGED)
        return files.join(known, "file", "left").select(*files.columns, status.alias("status"))

    def newest(self) -> dict[str, int]:
        """When each batch last got rows: one entry a batch."""
        rows = self.entries().where((F.col("state") == LOADED) & (F.col("rows") > 0)).groupBy("batch").agg(F.max("at").alias("at")).collect()
        return {r["batch"]: r["at"] for r in rows}

    def loads_of(self, batches: Sequence[str]) -> list[str]:
        """Committed loads that hold rows of the given batches."""
        found = self.entries().where((F.col("state") == LOADED) & F.col("batch").isin(list(batches))).select("load").distinct()
        return sorted(r["load"] for r in found.collect())

    def reconcile(self, since: int, skipped: DataFrame | None = None) -> DataFrame:
        """Per batch what loads from time ``since`` on brought, and what was there before.

        ``skipped`` (batch, status) adds files that were loaded already and files changed under an old name. Counts
        come from the manifest; no bronze row is read.
        """
        new, good = F.col("at") >= since, F.col("state") == LOADED
        total = lambda cond, c="rows": F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
        brought = self.entries().groupBy("batch").agg(
            total(good & ~new).alias("rows_before"), total(good).alias("rows_after"), total(good & new).alias("rows_loaded"),
            total(new, "error_rows").alias("error_rows"), F.count_if(good & ~new).alias("files_before"), F.count_if(good).alias("files_after"), F.count_if(good & new).alias("files_loaded"),
        )
        names = brought.columns[1:]
        if skipped is None:
            skipped = self.spark.createDataFrame([], "batch string, status string")
        passed = skipped.groupBy("batch").agg(F.count_if(F.col("status") == LOADED).alias("files_already_loaded"), F.count_if(F.col("status") == CHANGED).alias("files_changed"))
        both = brought.join(passed, "batch", "full_outer").na.fill(0, [*names, "files_already_loaded", "files_changed"])
        already = ((F.col("rows_loaded") == 0) & (F.col("rows_before") > 0)).alias("already_loaded")
        return both.select(F.col("batch").alias(UNIT[0]), *names, "files_already_loaded", "files_changed", already)


def folders(spark: SparkSession, bronze: str, loads: Sequence[str]) -> DataFrame:
    """All rows of some loads: only their folders are listed."""
    return spark.read.option("basePath", bronze).parquet(*[f"{bronze}/{LOAD}={name}" for name in loads])


def landed(spark: SparkSession, book: Manifest, bronze: str, batches: Sequence[str]) -> DataFrame:
    """Good rows of committed loads of some batches: no other load is listed, no other batch read."""
    loads = book.loads_of(batches)
    rows = folders(spark, bronze, loads) if loads else tables.read_table(spark, bronze).limit(0)
    return rows.where(F.col(UNIT[0]).isin(list(batches)) & F.col(REJECT).isNull()).drop(REJECT, LOAD)


def load_rows(spark: SparkSession, book: Manifest, bronze: str, raw: DataFrame) -> DataFrame:
    """Load rows that carry their batch and file name, skipping units that were loaded; returns the reconciliation.

    A row without a batch stops the load. Running it again adds nothing.
    """
    from .bronze import rows_of_unseen

    name, at = new_load()
    fresh = rows_of_unseen(raw, book.units(), UNIT)
    batch = F.coalesce(UNIT[0], F.raise_error(F.lit("a raw row has no _batch_id")).cast("string"))
    rows = fresh.withColumns({UNIT[0]: batch, LOAD: F.lit(name), REJECT: F.lit(None).cast("string")})
    written = write_observed(rows.hint("rebalance", F.col(UNIT[0])), bronze, (LOAD, UNIT[0]), {"rows": F.count(F.lit(1))})
    if written["rows"]:
        book.commit_written(bronze, name, at)
    return book.reconcile(at)


def load_files(
    spark: SparkSession,
    book: Manifest,
    bronze: str,
    directory: str,
    schema: T.StructType,
    batch: Column,
    pattern: str | None = None,
    file_format: str = "parquet",
    on_error: str = "abort",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Load the files of a folder that were never loaded; returns the reconciliation per batch.

    ``batch`` names a file's batch, as an expression of column ``file``. Good and bad rows of each file are counted
    by the write. Rows that a text format cannot parse, or that don't fit the schema, are bad: ``abort`` then commits
    nothing of the write, notes the files as failed and raises; ``quarantine`` keeps them in bronze, marked by
    their text, where readers pass them over. A Parquet file that cannot be read always stops the load. A file that
    changed under an old name is noted as such and not loaded.
    """
    if on_error not in ("abort", "quarantine"):
        raise ValueError(f"unknown error mode {on_error!r}")
    _, began = new_load()
    status = materialise(book.compare(list_files(spark, directory, pattern).withColumn("batch", batch)), "file-status")
    # File metadata, a row a file that is not loaded yet.
    open_files = status.where(F.col("status") != LOADED).orderBy("file").collect()
    changed = [r for r in open_files if r["status"] == CHANGED]
    if changed:
        name, at = new_load()
        book.commit(spark.createDataFrame([(name, r["batch"], r["file"], r["size"], r["modified"], 0, 0, CHANGED, at) for r in changed], _SCHEMA))
    fresh = [r for r in open_files if r["status"] == "new"]
    for start in range(0, len(fresh), MOST_FILES):
        files = fresh[start : start + MOST_FILES]
        name, at = new_load()
        reader = spark.read.format(file_format).options(**(options or {})).option("ignoreCorruptFiles", "false")
        text = file_format != "parquet"
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())]) if text else schema)
        if text:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT)
        meta = F.col("_metadata.file_path")
        rows = reader.load([r["file"] for r in files]).select("*", meta.alias(UNIT[1]))
        named = rows.withColumn("file", F.col(UNIT[1])).withColumns({UNIT[0]: batch, LOAD: F.lit(name), "_ingested_at": F.current_timestamp().cast("timestamp_ntz")}).drop("file")
        if not text:
            named = named.withColumn(REJECT, F.lit(None).cast("string"))
        bad = F.col(REJECT).isNotNull()
        metrics = {}
        for i, r in enumerate(files):
            own = F.col(UNIT[1]) == r["file"]
            metrics |= {f"good{i}": F.count_if(own & ~bad), f"bad{i}": F.count_if(own & bad)}
        counted = write_observed(named, bronze, (LOAD, UNIT[0]), metrics)
        errors = sum(counted[f"bad{i}"] for i in range(len(files)))
        stop = errors and on_error == "abort"
        entry = lambda i, r: (name, r["batch"], r["file"], r["size"], r["modified"], 0 if stop else counted[f"good{i}"], counted[f"bad{i}"], FAILED if stop else LOADED, at)
        book.commit(spark.createDataFrame([entry(i, r) for i, r in enumerate(files)], _SCHEMA))
        if stop:
            raise DataQualityError(f"{errors} rows of {sum(counted[f'bad{i}'] > 0 for i in range(len(files)))} files failed to load")
    return book.reconcile(began, status.where(F.col("status") != "new").select("batch", "status"))
