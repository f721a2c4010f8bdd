"""Policy study run: fit, attach coefficients, replace the run's rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, policy
from ..schema import PolicySpec
from ..session import materialise
from ..sources import tables


def run_policy_study(spark: SparkSession, daily: DataFrame, run_date: date, impact_path: str, spec: PolicySpec = PolicySpec()) -> int:
    """Write one row per zone and period for this run; a rerun replaces them."""
    rows = tables.conform(policy.impact_table(daily, run_date, spec), tables.IMPACT_SCHEMA)
    keyed = materialise(rows.withColumn("run_key", F.date_format("_run_date", "yyyy-MM-dd")), "impact")
    tables.replace_partitions(keyed, impact_path, "run_key")
    return keyed.count()


def score_anomalies(spark: SparkSession, daily: DataFrame, path: str) -> None:
    """Score all zone-days that have a baseline and replace their months."""
    scored = anomaly.score_days(daily).filter(F.col("z_score").isNotNull())
    rows = tables.conform(scored.withColumn("_scored_at", F.current_timestamp().cast("timestamp_ntz")), tables.ANOMALY_SCHEMA)
    tables.replace_partitions(rows.withColumn("anomaly_month", F.date_format("anomaly_date", "yyyy-MM")), path, "anomaly_month")
