"""Landing raw files: month scans, variant rows, load ledger and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import DataQualityError
from ..session import materialise

MONTH_PATTERN = "*_{month}.parquet"


def scan_months(
    spark: SparkSession,
    directory: str,
    months: Sequence[str],
    pattern: str = MONTH_PATTERN,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan only the files of the given months, with the file's URI as ``_source_file``.

    The months become path patterns, so other months are never listed or opened. A
    corrupt file fails the scan: ``ignoreCorruptFiles`` is switched off per read.
    """
    reader = spark.read.option("ignoreCorruptFiles", "false").option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    paths = [f"{directory.rstrip('/')}/{pattern.format(month=m)}" for m in months]
    return reader.parquet(*paths).select("*", F.col("_metadata.file_path").alias("_source_file"))


def as_variant_rows(raw: DataFrame, batch: Column | str, loaded_at: Column | None = None) -> DataFrame:
    """Land each record as one variant plus audit columns.

    Zone-free timestamps become epoch microseconds inside the variant.
    """
    data = [f for f in raw.schema.fields if not f.name.startswith("_")]
    values = [
        F.unix_micros(F.col(f.name).cast("timestamp")).alias(f.name)
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz")
        else F.col(f.name)
        for f in data
    ]
    return raw.select(
        F.to_variant_object(F.struct(*values)).alias("raw_data"),
        F.col("_source_file"),
        (loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")).alias("_ingested_at"),
        (F.lit(batch) if isinstance(batch, str) else batch).alias("_batch_id"),
    )


def land_variants(raw: DataFrame, path: str, batch: Column | str, loaded_at: Column | None = None) -> None:
    """Append records as variants, a few files a batch.

    The writer shreds the variant: fields that most rows of a file hold with one type become typed columns of the
    file (see ``session.configure``), and readers fetch the fields they ask for instead of whole records.
    """
    as_variant_rows(raw, batch, loaded_at).hint("rebalance", F.col("_batch_id")).write.mode("append").partitionBy("_batch_id").parquet(path)


def rows_per_file(df: DataFrame, file: str = "_source_file") -> DataFrame:
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("row_count"))


def file_ledger(rows: DataFrame) -> DataFrame:
    """Rows landed per batch and file: what a load has to be compared with."""
    return rows.groupBy("_batch_id", "_source_file").agg(F.count(F.lit(1)).alias("row_count"))


def unseen(available: DataFrame, ledger: DataFrame, key: str = "_batch_id") -> DataFrame:
    """Load units (files or batches) the ledger does not hold yet, old or new."""
    return available.select(key).distinct().join(ledger.select(key).distinct(), key, "left_anti")


def rows_of_unseen(raw: DataFrame, ledger: DataFrame, key: str | Sequence[str] = "_batch_id") -> DataFrame:
    """Rows of load units that were never loaded; running it again adds nothing.

    The ledger's distinct units (one per month or file) are written to the scratch folder, so that
    the join knows their size in bytes: below Spark's broadcast threshold they filter the raw rows
    in place, beyond it the rows are shuffled by load unit. NULL is a unit like any other, so rows
    without a file name are not loaded twice either.
    """
    keys = [key] if isinstance(key, str) else list(key)
    seen = materialise(ledger.select(*[F.col(k).alias(f"_seen{i}") for i, k in enumerate(keys)]).distinct(), "ledger")
    same = [F.col(k).eqNullSafe(F.col(f"_seen{i}")) for i, k in enumerate(keys)]
    return raw.join(seen, same, "left_anti")


def newer_than_watermark(raw: DataFrame, target: DataFrame, key: str = "_batch_id") -> DataFrame:
    """Rows strictly beyond the highest loaded batch; everything for an empty target.

    The maximum is an uncorrelated scalar subquery evaluated once by Spark, so nothing
    passes through the driver program and a partitioned scan is pruned by its value.
    """
    mark = target.agg(F.max(key).alias("mark")).select("mark")
    return raw.filter(F.col(key) > F.coalesce(mark.scalar(), F.lit("")))


def _loaded(n_before: DataFrame, n_after: DataFrame, key: str, counts: Sequence[str]) -> DataFrame:
    names = [f"{c}_{when}" for c in counts for when in ("before", "after")]
    both = n_before.join(n_after, key, "full_outer").na.fill(0, names)
    for c in counts:
        both = both.withColumn(f"{c}_loaded", F.greatest(F.col(f"{c}_after") - F.col(f"{c}_before"), F.lit(0)))
    already = (F.col("rows_loaded") == 0) & (F.col("rows_before") > 0)
    return both.select(key, *[f"{c}_{when}" for c in counts for when in ("before", "after", "loaded")], already.alias("already_loaded"))


def reconcile(before: DataFrame, after: DataFrame, key: str = "_batch_id") -> DataFrame:
    """Rows before and after a load per batch, and what the load added."""
    n_before = before.groupBy(key).agg(F.count(F.lit(1)).alias("rows_before"))
    n_after = after.groupBy(key).agg(F.count(F.lit(1)).alias("rows_after"))
    return _loaded(n_before, n_after, key, ["rows"])


def reconcile_files(before: DataFrame, after: DataFrame, key: str = "_batch_id") -> DataFrame:
    """Rows and files before and after a load per batch, from two file ledgers."""

    def per_batch(ledger: DataFrame, when: str) -> DataFrame:
        return ledger.groupBy(key).agg(F.sum("row_count").alias(f"rows_{when}"), F.count(F.lit(1)).alias(f"files_{when}"))

    return _loaded(per_batch(before, "before"), per_batch(after, "after"), key, ["rows", "files"])


def require_load(reconciled: DataFrame, batch: str, error_rows: int = 0, key: str = "_batch_id") -> None:
    """Stop the run on error rows, or when a batch added nothing and held nothing.

    Error rows are those that the reconciliation counted for the batch, if it counts them, and ``error_rows``.
    """
    counted = F.coalesce(F.sum("error_rows"), F.lit(0)) if "error_rows" in reconciled.columns else F.lit(0)
    row = reconciled.filter(F.col(key) == batch).agg(
        F.coalesce(F.max("rows_loaded"), F.lit(0)).alias("loaded"),
        F.coalesce(F.max("rows_before"), F.lit(0)).alias("before"),
        counted.alias("errors"),
    ).first()
    if error_rows + row.errors > 0:
        raise DataQualityError(f"batch {batch}: {error_rows + row.errors} rows failed to load")
    if row.loaded == 0 and row.before == 0:
        raise DataQualityError(f"batch {batch}: no rows loaded and none were present")
