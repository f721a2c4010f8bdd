"""Views of the given tables as trip files, zone dimension and demand panel.

The engine itself takes any trip table; these views let its operators run on the
star-schema test tables. Money is built from whole cents so that every engine sees
the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import hour_of
from ..functions.numeric import exact_sum

_LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
)
_BASE = [
    "l_orderkey AS ok",
    "l_linenumber AS ln",
    "CAST(CASE l_linenumber % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 7 ELSE 9 END AS INT) AS VendorID",
    "CAST(l_suppkey % 26 AS INT) AS PULocationID",
    "CAST(l_partkey % 26 AS INT) AS DOLocationID",
    "CAST(timestamp_micros(CAST((1704067200 + ((l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 786240)*60"
    " + (l_orderkey*13) % 60)*1000000 AS BIGINT)) AS TIMESTAMP_NTZ) AS tpep_pickup_datetime",
    "CAST(l_quantity AS BIGINT)*60 + l_linenumber*7 - 90 AS dur",
    "CAST(CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_linenumber % 6 END AS DOUBLE) AS passenger_count",
    "l_quantity/4.0D - 0.25D AS trip_distance",
    "CAST(CASE WHEN l_partkey % 40 = 0 THEN 99 WHEN l_partkey % 41 = 0 THEN NULL"
    " ELSE 1 + l_partkey % 5 END AS DOUBLE) AS RatecodeID",
    "CAST(l_orderkey % 7 AS BIGINT) AS payment_type",
    "CASE WHEN l_orderkey % 33 = 0 THEN -1 ELSE 1 END * CAST(floor(l_extendedprice/10.0D) AS BIGINT) AS fc",
    "CAST(round(l_discount*100) AS BIGINT) AS disc",
    "CAST(round(l_tax*100) AS BIGINT) AS tax",
    "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag",
    "CAST(l_linenumber % 3 AS DOUBLE)/2.0D AS extra",
    "CASE WHEN l_suppkey % 10 = 0 THEN 6.55D ELSE 0.0D END AS tolls_amount",
]

_TRIPS = [
    "VendorID",
    "tpep_pickup_datetime",
    "CAST(timestampadd(SECOND, dur, tpep_pickup_datetime) AS TIMESTAMP_NTZ) AS tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fc/100.0D AS fare_amount",
    "extra",
    "0.5D AS mta_tax",
    "CAST(floor(fc*disc/100.0D) AS BIGINT)/100.0D AS tip_amount",
    "tolls_amount",
    "1.0D AS improvement_surcharge",
    "2.5D AS congestion_surcharge",
    "CASE WHEN PULocationID IN (3,7) THEN 1.75D ELSE 0.0D END AS airport_fee",
    "CASE WHEN tpep_pickup_datetime >= TIMESTAMP_NTZ '2025-01-05 00:00:00' AND PULocationID % 5 = 1 THEN 0.75D END"
    " AS cbd_congestion_fee",
    "(fc + CAST(floor(fc*tax/100.0D) AS BIGINT) + 250)/100.0D AS base_total",
    "CASE WHEN ok % 100 = 0 THEN '2024-01' ELSE date_format(tpep_pickup_datetime,'yyyy-MM') END AS _batch_id",
]


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a given table; its schema is read from the footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip rows with audit columns; one zone's trips are delivered a second time.

    The second delivery is an ``explode`` of the first, so the table is scanned once.
    """
    lines = table(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS)
    base = lines.selectExpr(*_BASE).selectExpr(*_TRIPS)
    deliveries = F.when(F.col("DOLocationID") == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = base.withColumn("_delivery", F.explode(deliveries))
    return rows.select(
        *[c for c in rows.columns if c not in ("base_total", "_batch_id", "_delivery")],
        (F.col("base_total") + F.col("_delivery")).alias("total_amount"),
        F.concat(F.lit("trips_"), F.col("_batch_id"), F.lit(".parquet")).alias("_source_file"),
        F.expr("CAST(TIMESTAMP_NTZ '2025-07-01 00:00:00' + make_dt_interval(_delivery) AS TIMESTAMP_NTZ)").alias(
            "_ingested_at"
        ),
        "_batch_id",
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension from nation and region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "CAST(n_nationkey AS INT) AS LocationID",
        "CASE r_name WHEN 'AMERICA' THEN 'Manhattan' WHEN 'ASIA' THEN 'Queens' WHEN 'EUROPE' THEN 'Brooklyn'"
        " WHEN 'AFRICA' THEN 'Bronx' ELSE 'Staten Island' END AS Borough",
        "n_name AS Zone",
        "CASE r_name WHEN 'AMERICA' THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone",
    )


def event_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-hour demand from the event stream table."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            hour_of("ts").alias("pickup_hour"),
            (F.col("user_id") % 25).cast("int").alias("pu_location_id"),
        )
        .agg(F.count(F.lit(1)).alias("trip_count"), exact_sum("value").alias("total_congestion_fees"))
    )
