"""Writing result tables: append, typed insert, delete, upsert, replace.

Tables are Parquet folders partitioned by a text month or run date. Changes are
dynamic partition overwrites: Spark stages the new files and swaps whole partitions at
job commit, so files being read stay in place until the write has succeeded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, unsorted_writes

_TYPES = {
    "text": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "flag": T.BooleanType(),
    "date": T.DateType(),
    "time": T.TimestampNTZType(),
}


def _schema(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# Columns and types of the result tables.
FORECAST_SCHEMA = _schema(
    {
        "pickup_hour": "time", "pu_location_id": "int", "pickup_borough": "text", "predicted_trip_count": "double",
        "model_version": "text", "_run_date": "date",
    }
)
IMPACT_SCHEMA = _schema(
    {
        "pu_location_id": "int", "pickup_borough": "text", "service_zone": "text", "period": "text", "treated": "flag",
        "avg_trip_count": "double", "avg_revenue": "double", "avg_congestion_fees": "double", "did_trip_count": "double",
        "did_revenue": "double", "p_value_trip_count": "double", "p_value_revenue": "double", "r2_trip_count": "double",
        "r2_revenue": "double", "_run_date": "date",
    }
)
MONITORING_SCHEMA = _schema(
    {
        "monitor_date": "date", "prediction_month": "text", "model_version": "text", "model_run_id": "text", "mae": "double",
        "rmse": "double", "mape": "double", "training_test_mape": "double", "baseline_mape": "double", "mape_degraded": "flag",
        "n_predictions": "bigint", "n_actuals": "bigint", "drifted_features": "text", "n_drifted_features": "bigint",
        "_scored_at": "time",
    }
)
ANOMALY_SCHEMA = _schema(
    {
        "anomaly_date": "date", "pu_location_id": "int", "pickup_borough": "text", "trip_count": "bigint", "z_score": "double",
        "revenue_z_score": "double", "is_anomaly": "flag", "_scored_at": "time",
    }
)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at ``path``: the file system is asked for files, no footer is read."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return False
    return any(not s.getPath().getName().startswith(("_temporary", ".", "_SUCCESS")) for s in fs.listStatus(folder))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Check required columns and cast to the table's types."""
    have = {c.lower() for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"missing columns for insert: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append(df: DataFrame, path: str, schema: T.StructType, partition_by: str | None = None, overwrite: bool = False) -> None:
    """Typed insert; ``overwrite`` replaces the whole table."""
    writer = conform(df, schema).write.mode("overwrite" if overwrite else "append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: str, arranged: bool = False) -> None:
    """Replace exactly the partitions present in ``df``; running it twice changes nothing.

    Rows are shuffled to their partition value before the write so that each partition
    gets few files; the rebalance hint lets adaptive execution split an oversized one.
    Rows read from a table with the same partitions are ``arranged`` already and are copied without a shuffle.
    """
    rows = df if arranged else df.hint("rebalance", F.col(partition_by))
    with unsorted_writes(df.sparkSession):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def replace_listed(spark: SparkSession, df: DataFrame, path: str, partition_by: str, values: Sequence[str], arranged: bool = False) -> None:
    """Make the listed partitions hold exactly the rows of ``df``.

    A listed partition that ``df`` has no row of is emptied; a dynamic overwrite alone would leave its old
    rows. ``df`` is read twice, so it should be a written table.
    """
    left = touched_values(df, partition_by)
    old = touched_values(read_table(spark, path).filter(F.col(partition_by).isin(list(values))), partition_by) if exists(spark, path) else []
    if left or not exists(spark, path):
        replace_partitions(df, path, partition_by, arranged)
    for value in old:
        if value not in left:
            _empty_partition(spark, path, partition_by, value)


def touched_values(df: DataFrame, partition_by: str) -> list[str]:
    """Distinct partition values of a change set: table metadata, not data."""
    return sorted(r[0] for r in df.select(partition_by).distinct().collect())


def delete_where(spark: SparkSession, path: str, predicate: Column, partition_by: str) -> None:
    """Delete matching rows; a missing table is left alone.

    Only partitions holding a match are rewritten. A partition whose rows all match has
    nothing to write, so it is emptied by name.
    """
    if not exists(spark, path):
        return
    current = read_table(spark, path)
    hit = F.coalesce(predicate, F.lit(False))
    stats = (
        current.groupBy(partition_by)
        .agg(F.count_if(hit).alias("gone"), F.count_if(~hit).alias("kept"))
        .filter(F.col("gone") > 0)
        .collect()
    )
    rewrite = [r[partition_by] for r in stats if r["kept"] > 0]
    empty = [r[partition_by] for r in stats if r["kept"] == 0]
    if rewrite:
        kept = current.filter(F.col(partition_by).isin(rewrite) & ~hit)
        replace_partitions(kept, path, partition_by)
    for value in empty:
        _empty_partition(spark, path, partition_by, value)


def _empty_partition(spark: SparkSession, path: str, partition_by: str, value: str) -> None:
    """Overwrite one partition by a file without rows: readers see it gone, the table keeps its columns."""
    columns = T.StructType([f for f in read_table(spark, path).schema.fields if f.name != partition_by])
    spark.createDataFrame([], columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/{partition_by}={value}")


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows whose key is not in ``new``, and all new rows.

    A NULL key never equals another, so such rows are kept on both sides, as in a merge.
    """
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partition_by: str) -> list[str]:
    """Merge ``new`` into the table by key, rewriting only the partitions it touches.

    A key must determine its partition (the key holds the time the month is cut from).
    The change set is written once to scratch: it is read for its partition values, for
    the anti join and for the union. Returns the touched partition values.
    """
    change = materialise(new, "upsert")
    touched = touched_values(change, partition_by)
    if not touched:
        return touched
    if exists(spark, path):
        old = read_table(spark, path).filter(F.col(partition_by).isin(touched))
        result = merged(old.select(*change.columns), change, keys)
    else:
        result = change
    replace_partitions(result, path, partition_by)
    return touched


def replace_run(spark: SparkSession, path: str, df: DataFrame, run_column: str, partition_by: str) -> None:
    """Idempotent rerun of a scoring job.

    Rows of the same run date are deleted wherever they are, then the partitions in
    ``df`` (whole forecast months) are replaced.
    """
    change = materialise(df, "run")
    runs = [r[0] for r in change.select(run_column).distinct().collect()]
    delete_where(spark, path, F.col(run_column).isin(runs), partition_by)
    replace_partitions(change, path, partition_by)


def version_of(df: DataFrame) -> str:
    """A name for the stored input of ``df``: it changes whenever a file of a table it reads is written anew.

    Spark gives every written file a name of its own, so the sorted names are enough; they are metadata.
    """
    return hashlib.sha256("\n".join(sorted(df.inputFiles())).encode()).hexdigest()[:16]


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], version: str = "") -> DataFrame:
    """Read a saved result, or compute and save it first; results of another ``version`` of the input are not read."""
    target = f"{path}_{version}" if version else path
    if not exists(spark, target):
        build().write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target)
