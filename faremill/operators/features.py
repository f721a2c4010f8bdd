"""Demand panel and feature matrix."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import hour_number, next_day, ntz_literal, weekday_monday0
from ..functions.numeric import exact_sum
from ..schema import BOROUGH_CODES, BOROUGH_DEFAULT_CODE, FEATURES, PanelSpec
from .windows import CHUNK, OWN, POSITION, own_rows, range_chunks, row_chunks, series_window

# Look-back of the features in rows (or hours).
LAGS = (1, 24, 168)
ROLLING = (24, 168)
WEEK_HOURS = 168


def demand_panel(hourly: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Collapse vendors: one row per hour and zone."""
    measures = [F.sum(spec.target).alias(spec.target)]
    if spec.exogenous:
        measures.append(exact_sum(spec.exogenous).alias(spec.exogenous))
    if spec.group:
        measures.insert(0, F.min(spec.group).alias(spec.group))
    return hourly.groupBy(spec.time, spec.key).agg(*measures)


def calendar_features(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    weekday = weekday_monday0(spec.time)
    return df.withColumns(
        {
            "hour_of_day": F.hour(spec.time),
            "day_of_week_num": weekday,
            "month": F.month(spec.time),
            "is_weekend": (weekday >= 5).cast("int"),
        }
    )


def borough_code(borough: Column | str) -> Column:
    """Stable integer code of a borough; unknown names get the default code."""
    pairs = [F.lit(x) for item in BOROUGH_CODES.items() for x in item]
    name = F.col(borough) if isinstance(borough, str) else borough
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit(BOROUGH_DEFAULT_CODE))


def _by_series(df: DataFrame, spec: PanelSpec, chunked: bool) -> DataFrame:
    """Hash the series over the session's shuffle partitions ahead of their windows.

    This is the shuffle the windows need anyway. Naming the number keeps adaptive execution
    from merging small but compute-heavy partitions into one task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, spec.key, *([CHUNK] if chunked else []))


def row_lag_features(panel: DataFrame, spec: PanelSpec = PanelSpec(), rows_per_chunk: int | None = None) -> DataFrame:
    """Lags and trailing means counted in rows of each series, current row excluded.

    A trailing mean is the difference of two running sums, so its cost does not grow with
    the length of the window; the target is a whole number, hence the difference is exact.
    All windows share one partitioning and order: one shuffle and one sort. With
    ``rows_per_chunk`` a long series is spread over several tasks.
    """
    chunked = rows_per_chunk is not None
    if chunked:
        panel = row_chunks(panel, [spec.key], spec.time, max(LAGS + ROLLING), rows_per_chunk)
    w = series_window([spec.key], F.col(POSITION) if chunked else F.col(spec.time), chunked)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = _by_series(panel, spec, chunked).withColumns(
        {"_sum": F.sum(F.coalesce(F.col(spec.target), F.lit(0))).over(so_far), "_n": F.count(spec.target).over(so_far)}
    )
    columns = {f"lag_{k}h_{spec.target}": F.lag(F.col(spec.target).cast("double"), k).over(w) for k in LAGS}
    for k in ROLLING:
        total, n = (F.lag(c, 1).over(w) - F.lag(c, k + 1, 0).over(w) for c in ("_sum", "_n"))
        columns[f"rolling_{k}h_avg_{spec.target}"] = F.try_divide(total.cast("double"), n.cast("double"))
    if spec.exogenous:
        columns["lag_168h_congestion_fees"] = F.lag(F.col(spec.exogenous), WEEK_HOURS).over(w)
    out = running.withColumns(columns).drop("_sum", "_n")
    return own_rows(out) if chunked else out


def hour_lag_features(panel: DataFrame, spec: PanelSpec = PanelSpec(), hours_per_chunk: int | None = None) -> DataFrame:
    """The same features counted in clock hours: a missing hour gives NULL, not an older row.

    A range frame of exactly k hours holds at most one row because (key, hour) is unique,
    so no self join is needed. A trailing mean is the running sum up to the hour before less the running sum up to
    k hours earlier, each read off the last row there; such frames only grow, so their cost does not depend on the
    length of the window. The target is a whole number, hence the difference is exact.
    """
    df = panel.withColumn("_hour", hour_number(spec.time))
    chunked = hours_per_chunk is not None
    if chunked:
        df = range_chunks(df, F.col("_hour"), max(LAGS + ROLLING), hours_per_chunk)
    df = _by_series(df, spec, chunked)
    w = series_window([spec.key], "_hour", chunked)
    target = F.col(spec.target).cast("double")
    columns = {f"lag_{k}h_{spec.target}": F.max(target).over(w.rangeBetween(-k, -k)) for k in LAGS}
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.struct(F.sum(F.coalesce(F.col(spec.target), F.lit(0))).over(so_far).alias("sum"), F.count(spec.target).over(so_far).alias("n"))
    df = df.withColumn("_running", running)
    until = {k: F.last("_running").over(w.rangeBetween(Window.unboundedPreceding, -k)) for k in (1, *(k + 1 for k in ROLLING))}
    for k in ROLLING:
        total, n = (F.coalesce(until[1][c], F.lit(0)) - F.coalesce(until[k + 1][c], F.lit(0)) for c in ("sum", "n"))
        columns[f"rolling_{k}h_avg_{spec.target}"] = F.try_divide(total.cast("double"), n.cast("double"))
    if spec.exogenous:
        columns["lag_168h_congestion_fees"] = F.max(spec.exogenous).over(w.rangeBetween(-WEEK_HOURS, -WEEK_HOURS))
    out = df.withColumns(columns).drop("_hour", "_running")
    if chunked:
        out = out.filter(F.col(OWN)).drop(CHUNK, OWN)
    return out


def build_feature_matrix(
    hourly: DataFrame,
    start: date,
    end: date,
    lookback_hours: int = WEEK_HOURS,
    spec: PanelSpec = PanelSpec(),
    lag_unit: str = "rows",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Feature matrix for ``start``..``end`` (both included), look-back rows dropped.

    (key, hour) is unique in the panel, so one series has at most as many rows as the
    requested range has hours, whatever the number of trips. ``rows_per_chunk`` (hours, for
    clock-hour lags) spreads each series over several tasks where there are few keys.
    """
    first = datetime.combine(start, datetime.min.time()) - timedelta(hours=lookback_hours)
    first_hour = F.lit(first.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    in_range = (F.col(spec.time) >= first_hour) & (F.col(spec.time) < ntz_literal(next_day(end)))
    panel = demand_panel(hourly.filter(in_range), spec)
    lag = row_lag_features if lag_unit == "rows" else hour_lag_features
    lagged = lag(panel, spec, rows_per_chunk)
    out = calendar_features(lagged, spec)
    if spec.group:
        out = out.withColumn(f"{spec.group}_enc", borough_code(spec.group))
    return out.filter(F.col(spec.time) >= ntz_literal(start))


def complete_rows(matrix: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Drop rows with a NULL feature."""
    return matrix.dropna(subset=list(features))


def sequences(
    matrix: DataFrame,
    lookback: int,
    features: Sequence[str] = FEATURES,
    spec: PanelSpec = PanelSpec(),
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Each row with the ``lookback`` feature rows before it in its own series.

    Series never mix, and rows without a full history give no sequence.
    """
    chunked = rows_per_chunk is not None
    if chunked:
        matrix = row_chunks(matrix, [spec.key], spec.time, lookback, rows_per_chunk)
    w = series_window([spec.key], F.col(POSITION) if chunked else F.col(spec.time), chunked)
    step = F.array(*[F.col(c).cast("double") for c in features])
    out = matrix.withColumn("sequence", F.collect_list(step).over(w.rowsBetween(-lookback, -1)))
    if chunked:
        out = own_rows(out)
    return out.filter(F.size("sequence") == lookback).select(spec.key, spec.time, "sequence", F.col(spec.target).alias("target"))


def feature_baseline(train: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Mean and sample standard deviation per feature on the training rows, one pass."""
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_samp(x).alias(f"s_{c}")]
    wide = train.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std"))
            for i, c in enumerate(features)
        ]
    )
    return wide.select(F.inline(rows))
