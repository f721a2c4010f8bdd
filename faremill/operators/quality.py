"""Data-quality tests. Each table is checked in as few passes as possible."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import ntz_literal
from ..schema import FEATURES, TARGET, PanelSpec

# Columns that must be filled, and the unique key, per table.
SILVER_NOT_NULL = (
    "trip_id", "vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "pu_location_id", "do_location_id",
    "passenger_count", "trip_distance", "payment_type", "fare_amount", "total_amount", "_source_file",
    "_ingested_at", "_batch_id",
)
HOURLY_NOT_NULL = (
    "fct_id", "pickup_hour", "pickup_date", "hour_of_day", "day_of_week", "pu_location_id", "pickup_borough",
    "pickup_zone", "service_zone", "vendor_id", "vendor_name", "trip_count", "total_passengers",
    "avg_passengers_per_trip", "total_revenue", "total_fare", "revenue_per_trip", "total_distance_miles",
    "avg_distance_miles", "revenue_per_mile", "avg_trip_duration_minutes", "credit_card_trip_pct",
    "total_congestion_fees", "total_airport_fees",
)
DAILY_NOT_NULL = (
    "fct_id", "pickup_date", "day_of_week", "pu_location_id", "pickup_borough", "pickup_zone", "service_zone",
    "trip_count", "total_passengers", "avg_passengers_per_trip", "total_revenue", "total_fare", "revenue_per_trip",
    "total_distance_miles", "avg_distance_miles", "revenue_per_mile", "avg_trip_duration_minutes",
    "credit_card_trip_pct", "total_congestion_fees", "total_airport_fees",
)
# Limits of the feature-matrix checks.
MIN_ROWS = 10_000
MAX_NULL_RATE = 0.05


class DataQualityError(Exception):
    """A gate between two steps did not pass."""


def not_null_failures(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column from a single aggregate, as one row per test."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "column_name", "failures")
    return long.select(F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("check_name"), "failures")


def unique_failures(df: DataFrame, table: str, key: str) -> DataFrame:
    """Number of key values that occur more than once (NULL keys are not compared)."""
    repeated = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    failures = repeated.agg(F.count_if(F.col("_n") > 1).alias("failures"))
    return failures.select(
        F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), F.lit("unique").alias("check_name"), "failures"
    )


def table_tests(df: DataFrame, table: str, key: str, columns: Sequence[str]) -> DataFrame:
    """Both kinds of tests in one pass over ``df``.

    Grouping by the key finds repeated keys; the groups carry partial NULL counts, which a second
    aggregate adds up. Rows without a key are one group that partial aggregation keeps small.
    """
    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns]
    )
    wide = per_key.agg(
        F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_repeated"),
        *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"_null_{c}") for c in columns],
    )
    results = [(c, "not_null", f"_null_{c}") for c in columns] + [(key, "unique", "_repeated")]
    rows = [
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(kind).alias("check_name"), F.col(n).alias("failures"))
        for c, kind, n in results
    ]
    return wide.select(F.inline(F.array(*rows)))


def require_clean(tests: DataFrame) -> None:
    """Gate between layers: raise when any test has failures."""
    bad = tests.filter(F.col("failures") > 0).orderBy("column_name", "check_name").collect()
    if bad:
        raise DataQualityError("; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in bad))


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataQualityError(f"missing columns: {missing}")


def null_rates(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Share of NULLs per column, one pass."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "null_rate")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def matrix_checks(
    df: DataFrame,
    train_end: date,
    spec: PanelSpec = PanelSpec(),
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
) -> DataFrame:
    """One row with everything the feature-matrix gate needs.

    Grouping by the key first counts duplicates in the same job as the other checks:
    the key groups carry partial counts, the second aggregate adds them up.
    """
    require_columns(df, features)
    in_train = F.col(spec.time) <= ntz_literal(train_end)
    per_key = df.groupBy(spec.key, spec.time).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(target) < 0).alias("_negative"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in features],
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("_negative"), F.lit(0)).alias("negative_targets"),
        F.max(F.when(in_train, F.col(spec.time))).alias("last_train_time"),
        *[F.try_divide(F.sum(f"_null_{c}").cast("double"), F.sum("_n").cast("double")).alias(f"null_rate_{c}") for c in features],
    )


def require_matrix(
    df: DataFrame,
    train_end: date,
    val_start: date,
    spec: PanelSpec = PanelSpec(),
    features: Sequence[str] = FEATURES,
    min_rows: int = MIN_ROWS,
    max_null_rate: float = MAX_NULL_RATE,
) -> None:
    """Feature-matrix gate: size, NULL share, leakage, duplicates, negative targets."""
    row = matrix_checks(df, train_end, spec, features).first()
    if row["row_count"] < min_rows:
        raise DataQualityError(f"{row['row_count']} rows, at least {min_rows} expected")
    for c in features:
        if row[f"null_rate_{c}"] > max_null_rate:
            raise DataQualityError(f"{c}: NULL share {row[f'null_rate_{c}']:.3f} is above {max_null_rate}")
    last = row["last_train_time"]
    if last is not None and last.date() >= val_start:
        raise DataQualityError(f"training rows reach {last}, validation starts {val_start}")
    if row["duplicate_rows"] > 0:
        raise DataQualityError(f"{row['duplicate_rows']} duplicate key rows")
    if row["negative_targets"] > 0:
        raise DataQualityError(f"{row['negative_targets']} negative targets")
