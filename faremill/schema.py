"""Field lists and rule sets shared by the layers."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import types as T

# Raw field name, typed column name and type of a trip record.
RAW_FIELDS: tuple[tuple[str, str, str], ...] = (
    ("VendorID", "vendor_id", "int"),
    ("RatecodeID", "rate_code_id", "int"),
    ("PULocationID", "pu_location_id", "int"),
    ("DOLocationID", "do_location_id", "int"),
    ("tpep_pickup_datetime", "tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "double"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("airport_fee", "airport_fee", "double"),
    ("cbd_congestion_fee", "cbd_congestion_fee", "double"),
    ("total_amount", "total_amount", "double"),
)
AUDIT_COLUMNS = ("_source_file", "_ingested_at", "_batch_id")

# Declared types of the zone dimension file.
ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TripRules:
    """Cleaning and revenue rules of the trip layers (fixed values of the data model)."""

    # Parts of the trip id text, in this order.
    trip_id_parts: tuple[str, ...] = ("vendor_id", "tpep_pickup_datetime", "pu_location_id")
    # Same columns for the window; the most distinct one leads so that the sort is
    # decided by its 8-byte prefix.
    dedup_keys: tuple[str, ...] = ("tpep_pickup_datetime", "pu_location_id", "vendor_id")
    # Load time first; the rest makes the winner unique when load times tie.
    dedup_tiebreak: tuple[str, ...] = (
        "do_location_id",
        "total_amount",
        "fare_amount",
        "tpep_dropoff_datetime",
        "trip_distance",
        "passenger_count",
        "payment_type",
        "rate_code_id",
    )
    unknown_rate_code: int = 99
    first_year: int = 2015
    last_year: int = 2030
    card_payment: int = 1
    excluded_payments: tuple[int, ...] = (3, 4, 6)
    vendor_labels: dict[int, str] = field(
        default_factory=lambda: {1: "CMT", 2: "Curb", 6: "Myle", 7: "Helix"}
    )
    missing_label: str = "Unknown"


# Integer codes of the boroughs in the feature matrix.
BOROUGH_CODES = {
    "Manhattan": 0,
    "Brooklyn": 1,
    "Queens": 2,
    "Bronx": 3,
    "Staten Island": 4,
    "EWR": 5,
    "Unknown": 6,
}
BOROUGH_DEFAULT_CODE = 6

# Model features in column order, and the target.
FEATURES: tuple[str, ...] = (
    "hour_of_day",
    "day_of_week_num",
    "month",
    "is_weekend",
    "lag_1h_trip_count",
    "lag_24h_trip_count",
    "lag_168h_trip_count",
    "rolling_24h_avg_trip_count",
    "rolling_168h_avg_trip_count",
    "pu_location_id",
    "lag_168h_congestion_fees",
)
TARGET = "trip_count"

# The same columns by family; studies leave out whole families. The borough code is no feature at present.
FEATURE_FAMILIES: dict[str, frozenset[str]] = {
    "lag": frozenset(("lag_1h_trip_count", "lag_24h_trip_count", "lag_168h_trip_count")),
    "fee": frozenset(("lag_168h_congestion_fees",)),
    "rolling": frozenset(("rolling_24h_avg_trip_count", "rolling_168h_avg_trip_count")),
    "borough": frozenset(("pickup_borough_enc",)),
}


def without(*families: str) -> tuple[str, ...]:
    """The features, in order, less those of some families."""
    out = frozenset().union(*(FEATURE_FAMILIES[f] for f in families))
    return tuple(c for c in FEATURES if c not in out)


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of a time-series panel, one row per (key, time)."""

    key: str = "pu_location_id"
    time: str = "pickup_hour"
    target: str = "trip_count"
    exogenous: str | None = "total_congestion_fees"
    group: str | None = "pickup_borough"


@dataclass(frozen=True)
class PolicySpec:
    """Treatment definition of the policy study (fixed values of the study design)."""

    start: date = date(2024, 1, 1)
    effective: date = date(2025, 1, 5)
    treated_borough: str = "Manhattan"
    treated_service_zone: str = "Yellow Zone"
    control_boroughs: tuple[str, ...] = ("Brooklyn", "Queens", "Bronx")
    key: str = "pu_location_id"
    day: str = "pickup_date"
    weekday: str = "day_of_week"
