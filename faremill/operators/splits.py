"""Time-based train, validation and test splits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_end, month_start, next_day, ntz_literal

# First training day, months between a run and its test month.
HISTORY_START = date(2024, 1, 1)
TEST_LAG = 2


@dataclass(frozen=True)
class SplitDates:
    train_start: date
    train_end: date
    val_start: date
    val_end: date
    test_start: date
    test_end: date


def rolling_splits(run_date: date, offset: int = 0, lag: int = TEST_LAG, history_start: date = HISTORY_START) -> SplitDates:
    """Test is the month ``lag + offset`` before the run, validation the month before it."""
    test = month_start(run_date, lag + offset)
    val = month_start(test, 1)
    return SplitDates(history_start, val - timedelta(days=1), val, month_end(val), test, month_end(test))


def split_column(time: str, s: SplitDates, mode: str = "parity") -> Column:
    """``train``, ``val``, ``test`` or NULL for each row.

    ``parity`` compares with the midnights of the limit dates, so hours 01-23 of the last
    train and validation day belong to no split and the test part has no upper limit.
    ``fixed`` uses whole days.
    """
    t = F.col(time)
    if mode == "parity":
        train = t <= ntz_literal(s.train_end)
        val = (t >= ntz_literal(s.val_start)) & (t <= ntz_literal(s.val_end))
        test = t >= ntz_literal(s.test_start)
    elif mode == "fixed":
        train = (t >= ntz_literal(s.train_start)) & (t < ntz_literal(s.val_start))
        val = (t >= ntz_literal(s.val_start)) & (t < ntz_literal(next_day(s.val_end)))
        test = (t >= ntz_literal(s.test_start)) & (t < ntz_literal(next_day(s.test_end)))
    else:
        raise ValueError(f"unknown split mode {mode!r}")
    return F.when(train, F.lit("train")).when(val, F.lit("val")).when(test, F.lit("test"))


def assign_split(df: DataFrame, s: SplitDates, time: str = "pickup_hour", mode: str = "parity") -> DataFrame:
    return df.withColumn("split", split_column(time, s, mode))


def walk_forward(
    df: DataFrame, run_date: date, folds: int = 3, time: str = "pickup_hour", mode: str = "parity"
) -> DataFrame:
    """Each row once per fold it takes part in, with ``fold`` and ``split``.

    Fold k moves every limit k months back. The folds are a literal array expanded per
    row, so the table is scanned once whatever the number of folds.
    """
    members = F.array(
        *[
            F.struct(F.lit(k).alias("fold"), split_column(time, rolling_splits(run_date, k), mode).alias("split"))
            for k in range(folds)
        ]
    )
    return df.withColumn("_m", F.explode(members)).filter(F.col("_m.split").isNotNull()).select(
        *df.columns, F.col("_m.fold").alias("fold"), F.col("_m.split").alias("split")
    )


def scoring_window(run_date: date, lag: int = TEST_LAG) -> tuple[date, date]:
    """First and last day of the month a run scores."""
    first = month_start(run_date, lag)
    return first, month_end(first)
