"""Which months to load: publication lag, rolling window, backfill list."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import MONTH_FORMAT, month_start

# Months between a run and its data, months checked on each run.
PUBLICATION_LAG = 2
WINDOW_MONTHS = 6


def batch_month(run_date: date, lag: int = PUBLICATION_LAG) -> str:
    """Month text a run loads: the run's month minus the publication lag."""
    return month_start(run_date, lag).strftime("%Y-%m")


def batch_month_column(run_date: Column, lag: int = PUBLICATION_LAG) -> Column:
    return F.date_format(F.add_months(F.trunc(run_date, "month"), -lag), MONTH_FORMAT)


def month_series(first: Column, last: Column) -> Column:
    """Array of month texts from ``first`` to ``last``, both included (empty if reversed)."""
    a, b = F.trunc(first, "month"), F.trunc(last, "month")
    months = F.sequence(a, b, F.expr("interval 1 month"))
    return F.when(a <= b, F.transform(months, lambda d: F.date_format(d, MONTH_FORMAT))).otherwise(
        F.array().cast("array<string>")
    )


def rolling_window(runs: DataFrame, run_date: str, months: int = WINDOW_MONTHS, lag: int = PUBLICATION_LAG) -> DataFrame:
    """For each run date, the ``months`` newest publishable months."""
    newest = F.add_months(F.trunc(F.col(run_date), "month"), -lag)
    series = month_series(F.add_months(newest, 1 - months), newest)
    return runs.select(run_date, F.explode(series).alias("batch_month"))


def missing_months(window: DataFrame, loaded: DataFrame, batch: str = "_batch_id") -> DataFrame:
    """Months of the window that are not in storage yet.

    ``loaded`` may be a whole table; it is reduced to its distinct batches first.
    """
    have = loaded.select(F.col(batch).alias("batch_month")).distinct()
    return window.join(have, "batch_month", "left_anti")


def backfill_months(bounds: DataFrame, first: str, run_date: str, lag: int = PUBLICATION_LAG) -> DataFrame:
    """Months from ``first`` up to, not including, the month ``lag`` before the run."""
    cutoff = F.add_months(F.trunc(F.col(run_date), "month"), -lag)
    return bounds.select(F.explode(month_series(F.col(first), F.add_months(cutoff, -1))).alias("batch_month"))
