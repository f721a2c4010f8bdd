"""Session settings and the shared scratch folder every job writes intermediates to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on.

    Only settings of results and storage format are touched; parallelism, memory and broadcast
    limits stay as the cluster configured them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A sum or cast beyond its type must stop the job, not wrap or turn into NULL.
    spark.conf.set("spark.sql.ansi.enabled", "true")
    # Month partitions are text; '2024-01' must not be read back as a date or number.
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    # Variants are stored with their common fields as typed Parquet columns, and a path look-up reads just its column.
    # Values are the same either way; a field that changes its type from row to row stays in the variant.
    for setting in ("writeShredding.enabled", "inferShreddingSchema", "allowReadingShredded", "pushVariantIntoScan"):
        spark.conf.set(f"spark.sql.variant.{setting}", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by the cluster.

    Only in local mode, where driver and tasks share one disk, a temporary folder stands in
    for a missing setting; a cluster that names none is refused, because its executors would
    write to disks that others don't see.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_CONF, None) or sc.getConf().get(_CHECKPOINT_CONF, None)
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="faremill-")
        sc.setCheckpointDir(configured)
        configured = sc.getCheckpointDir()
    return configured.rstrip("/")


#: Partitions that a task writes at the same time without sorting its rows by them first; beyond that it sorts the rest.
MOST_WRITERS = 24
_WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside stream each row to its partition's file: a task holds file buffers, not its rows."""
    before = spark.conf.get(_WRITERS_CONF, "0")
    spark.conf.set(_WRITERS_CONF, str(MOST_WRITERS))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS_CONF, before)


_open_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the scratch folders that were named inside.

    For jobs that publish what they made; a result that is read later must not come from such a folder.
    """
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the scratch root."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


def materialise(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the scratch folder and return a scan of it.

    Used where one result feeds several jobs (model fits, folds, global row
    positions). Parquet keeps column pruning for the later reads, and a lost
    executor costs a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if partition_by:
        # Few files a partition, whatever the number of tasks; an oversized partition is split.
        with unsorted_writes(spark):
            df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
