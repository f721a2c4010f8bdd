"""Queries over the demand panel: features, splits, baselines, errors and ranks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.numeric import round_half_up
from ..operators import anomaly, ensembles, evaluation, features, monitoring, quality, splits, windows
from ..schema import FEATURES
from ..session import materialise
from ..sources import tables
from . import inputs, oracle
from .catalog import DT, TS, daily_of, hourly_of, register, rounded
from .oracle import block, half_up, total

RUN_DATE = date(2025, 8, 5)
SPLITS = splits.rolling_splits(RUN_DATE)
KEYS = ["pu_location_id", "pickup_hour"]

block(
    "panel",
    f"""SELECT pickup_hour, pu_location_id, min(pickup_borough) AS pickup_borough, CAST(sum(trip_count) AS BIGINT) AS trip_count,
    {total("total_congestion_fees")} AS total_congestion_fees FROM hourly GROUP BY 1, 2""",
    "hourly",
)


def _features_sql(source: str, start: str) -> str:
    return f"""SELECT * FROM (SELECT *,
    CAST(lag(trip_count, 1) OVER w AS DOUBLE) AS lag_1h_trip_count, CAST(lag(trip_count, 24) OVER w AS DOUBLE) AS lag_24h_trip_count,
    CAST(lag(trip_count, 168) OVER w AS DOUBLE) AS lag_168h_trip_count,
    avg(trip_count) OVER (PARTITION BY pu_location_id ORDER BY pickup_hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS rolling_24h_avg_trip_count,
    avg(trip_count) OVER (PARTITION BY pu_location_id ORDER BY pickup_hour ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS rolling_168h_avg_trip_count,
    lag(total_congestion_fees, 168) OVER w AS lag_168h_congestion_fees,
    CAST(hour(pickup_hour) AS BIGINT) AS hour_of_day, CAST(isodow(pickup_hour) - 1 AS BIGINT) AS day_of_week_num,
    CAST(month(pickup_hour) AS BIGINT) AS month, CAST(CASE WHEN isodow(pickup_hour) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
    CAST(CASE pickup_borough WHEN 'Manhattan' THEN 0 WHEN 'Brooklyn' THEN 1 WHEN 'Queens' THEN 2 WHEN 'Bronx' THEN 3
      WHEN 'Staten Island' THEN 4 WHEN 'EWR' THEN 5 ELSE 6 END AS BIGINT) AS pickup_borough_enc
  FROM {source} WINDOW w AS (PARTITION BY pu_location_id ORDER BY pickup_hour))
  WHERE pickup_hour >= TIMESTAMP '{start} 00:00:00'"""


block("matrix", _features_sql("panel", "2024-01-01"), "panel")
block(
    "month_matrix",
    _features_sql(
        "(SELECT * FROM panel WHERE pickup_hour >= TIMESTAMP '2025-05-25 00:00:00' AND pickup_hour < TIMESTAMP '2025-07-01 00:00:00')",
        "2025-06-01",
    ),
    "panel",
)
block("complete", "SELECT * FROM matrix WHERE lag_168h_trip_count IS NOT NULL AND lag_168h_congestion_fees IS NOT NULL", "matrix")
block(
    "split",
    f"""SELECT *, CASE WHEN pickup_hour <= TIMESTAMP '{SPLITS.train_end} 00:00:00' THEN 'train'
    WHEN pickup_hour >= TIMESTAMP '{SPLITS.val_start} 00:00:00' AND pickup_hour <= TIMESTAMP '{SPLITS.val_end} 00:00:00' THEN 'val'
    WHEN pickup_hour >= TIMESTAMP '{SPLITS.test_start} 00:00:00' THEN 'test' END AS split FROM complete""",
    "complete",
)
block("test_rows", "SELECT * FROM split WHERE split = 'test'", "split")
block(
    "naive",
    """SELECT *, (lag_1h_trip_count + lag_24h_trip_count + lag_168h_trip_count)/3.0E0 AS seasonal FROM test_rows""",
    "test_rows",
)


def _printed(extra: str = "") -> str:
    return f"* REPLACE ({TS.format('pickup_hour')}, CAST(pu_location_id AS BIGINT) AS pu_location_id){extra}"


def matrix_of(spark, sf_dir, **options):
    return features.build_feature_matrix(hourly_of(spark, sf_dir), SPLITS.train_start, SPLITS.test_end, **options)


def complete_of(spark, sf_dir):
    return features.complete_rows(matrix_of(spark, sf_dir))


def test_of(spark, sf_dir):
    rows = splits.assign_split(complete_of(spark, sf_dir), SPLITS)
    return rows.filter(F.col("split") == "test")


@register("demand_panel", oracle.sql(f"SELECT {_printed()} FROM panel", "panel"))
def _panel(spark, sf_dir):
    return features.demand_panel(hourly_of(spark, sf_dir))


@register("feature_matrix", oracle.sql(f"SELECT {_printed()} FROM matrix", "matrix"))
def _matrix(spark, sf_dir):
    return matrix_of(spark, sf_dir)


@register("feature_matrix_chunked", oracle.sql(f"SELECT {_printed()} FROM matrix", "matrix"))
def _matrix_chunked(spark, sf_dir):
    """The same matrix with every series cut into chunks of 300 rows."""
    return matrix_of(spark, sf_dir, rows_per_chunk=300)


@register("scoring_month_features", oracle.sql(f"SELECT {_printed()} FROM month_matrix", "month_matrix"))
def _month(spark, sf_dir):
    """Features of the forecast month from the month and its look-back only."""
    first, last = splits.scoring_window(RUN_DATE)
    return features.build_feature_matrix(hourly_of(spark, sf_dir), first, last)


_HOUR_LAGS = oracle.sql(
    f"""SELECT strftime(p.pickup_hour, '%Y-%m-%d %H:%M:%S') AS pickup_hour, CAST(p.pu_location_id AS BIGINT) AS pu_location_id,
    CAST(a.trip_count AS DOUBLE) AS lag_1h_trip_count, CAST(b.trip_count AS DOUBLE) AS lag_24h_trip_count,
    CAST(c.trip_count AS DOUBLE) AS lag_168h_trip_count, c.total_congestion_fees AS lag_168h_congestion_fees,
    {half_up("avg(p.trip_count) OVER (PARTITION BY p.pu_location_id ORDER BY p.pickup_hour RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING)", 9)}
      AS rolling_24h_avg_trip_count
  FROM panel p LEFT JOIN panel a ON a.pu_location_id = p.pu_location_id AND a.pickup_hour + INTERVAL 1 HOUR = p.pickup_hour
    LEFT JOIN panel b ON b.pu_location_id = p.pu_location_id AND b.pickup_hour + INTERVAL 24 HOUR = p.pickup_hour
    LEFT JOIN panel c ON c.pu_location_id = p.pu_location_id AND c.pickup_hour + INTERVAL 168 HOUR = p.pickup_hour""",
    "panel",
)
_HOUR_COLUMNS = [
    "pickup_hour", "pu_location_id", "lag_1h_trip_count", "lag_24h_trip_count", "lag_168h_trip_count",
    "lag_168h_congestion_fees", "rolling_24h_avg_trip_count",
]


@register("hour_exact_lags", _HOUR_LAGS)
def _hour_lags(spark, sf_dir):
    """Lags counted in clock hours through exact range frames."""
    out = features.hour_lag_features(features.demand_panel(hourly_of(spark, sf_dir))).select(*_HOUR_COLUMNS)
    return rounded(out, ["rolling_24h_avg_trip_count"], 9)


@register("hour_exact_lags_chunked", _HOUR_LAGS)
def _hour_lags_chunked(spark, sf_dir):
    panel = features.demand_panel(hourly_of(spark, sf_dir))
    return rounded(features.hour_lag_features(panel, hours_per_chunk=400).select(*_HOUR_COLUMNS), ["rolling_24h_avg_trip_count"], 9)


@register("event_panel", (
    "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS pickup_hour, CAST(user_id % 25 AS BIGINT) AS pu_location_id,"
    f" count(*) AS trip_count, {total('value')} AS total_congestion_fees FROM events GROUP BY 1, 2"))
def _event_panel(spark, sf_dir):
    """The panel operator on another event table."""
    return inputs.event_panel(spark, sf_dir)


@register("complete_rows", oracle.sql(
    "SELECT CAST(pu_location_id AS BIGINT) AS pu_location_id, count(*) AS n_rows FROM complete GROUP BY 1", "complete"))
def _complete(spark, sf_dir):
    return complete_of(spark, sf_dir).groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("split_counts", oracle.sql(
    "SELECT split, count(*) AS n_rows, strftime(min(pickup_hour), '%Y-%m-%d %H:%M:%S') AS first_hour,"
    " strftime(max(pickup_hour), '%Y-%m-%d %H:%M:%S') AS last_hour FROM split GROUP BY split", "split"))
def _split_counts(spark, sf_dir):
    """Rows per split with midnight limits; the gap hours have no split."""
    rows = splits.assign_split(complete_of(spark, sf_dir), SPLITS)
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("pickup_hour").alias("first_hour"), F.max("pickup_hour").alias("last_hour"))


@register("split_counts_whole_days", oracle.sql(
    "SELECT CASE WHEN pickup_hour < TIMESTAMP '2025-05-01 00:00:00' THEN 'train' WHEN pickup_hour < TIMESTAMP '2025-06-01 00:00:00' THEN 'val'"
    " ELSE 'test' END AS split, count(*) AS n_rows FROM complete GROUP BY 1", "complete"))
def _split_fixed(spark, sf_dir):
    rows = splits.assign_split(complete_of(spark, sf_dir), SPLITS, mode="fixed")
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def _fold_sql(k: int) -> str:
    s = splits.rolling_splits(RUN_DATE, k)
    return (
        f"SELECT CAST({k} AS BIGINT) AS fold, *, CASE WHEN pickup_hour <= TIMESTAMP '{s.train_end} 00:00:00' THEN 'train'"
        f" WHEN pickup_hour >= TIMESTAMP '{s.val_start} 00:00:00' AND pickup_hour <= TIMESTAMP '{s.val_end} 00:00:00' THEN 'val'"
        f" WHEN pickup_hour >= TIMESTAMP '{s.test_start} 00:00:00' THEN 'test' END AS split FROM complete"
    )


block("folds", "SELECT * FROM (" + " UNION ALL ".join(_fold_sql(k) for k in range(3)) + ") WHERE split IS NOT NULL", "complete")
_FOLD_MAPE = "SELECT fold, avg(abs((trip_count - lag_168h_trip_count)/trip_count))*100 AS mape FROM folds WHERE split = 'test' AND trip_count > 0 GROUP BY fold"


@register("walk_forward_splits", oracle.sql("SELECT fold, split, count(*) AS n_rows FROM folds GROUP BY 1, 2", "folds"))
def _folds(spark, sf_dir):
    members = splits.walk_forward(complete_of(spark, sf_dir), RUN_DATE)
    return members.groupBy("fold", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("walk_forward_naive", oracle.sql(
    f", f AS ({_FOLD_MAPE}) SELECT fold, {half_up('mape', 6)} AS mape, (SELECT count(*) FROM folds g WHERE g.fold = f.fold AND g.split = 'test') AS n_rows FROM f", "folds"))
def _fold_errors(spark, sf_dir):
    """Error of the week-lag forecast per fold."""
    return rounded(evaluation.walk_forward_naive(splits.walk_forward(complete_of(spark, sf_dir), RUN_DATE)), ["mape"])


@register("walk_forward_summary", oracle.sql(
    f", f AS ({_FOLD_MAPE}) SELECT {half_up('avg(mape)', 6)} AS mape_mean, {half_up('stddev_pop(mape)', 6)} AS mape_std, count(*) AS n_folds FROM f", "folds"))
def _fold_summary(spark, sf_dir):
    per_fold = evaluation.walk_forward_naive(splits.walk_forward(complete_of(spark, sf_dir), RUN_DATE))
    return rounded(evaluation.fold_summary(per_fold), ["mape_mean", "mape_std"])


def _metrics_sql(pred: str) -> str:
    return (
        f"{half_up(f'avg(abs(trip_count - {pred}))', 6)} AS mae, {half_up(f'sqrt(avg((trip_count - {pred})*(trip_count - {pred})))', 6)} AS rmse,"
        f" {half_up(f'avg(CASE WHEN trip_count > 0 THEN abs((trip_count - {pred})/trip_count) END)*100', 6)} AS mape, count(*) AS n_rows"
    )


@register("naive_week_lag", oracle.sql(f"SELECT {_metrics_sql('lag_168h_trip_count')} FROM naive", "naive"))
def _week_lag(spark, sf_dir):
    return rounded(evaluation.error_metrics(evaluation.naive_week_lag(test_of(spark, sf_dir))), ["mae", "rmse", "mape"])


@register("seasonal_naive", oracle.sql(f"SELECT {_metrics_sql('seasonal')} FROM naive", "naive"))
def _seasonal(spark, sf_dir):
    return rounded(evaluation.error_metrics(evaluation.seasonal_naive(test_of(spark, sf_dir))), ["mae", "rmse", "mape"])


@register("baseline_gain", oracle.sql(
    f", m AS (SELECT avg(abs((trip_count - rolling_168h_avg_trip_count)/trip_count))*100 AS t, avg(abs((trip_count - lag_168h_trip_count)/trip_count))*100 AS b"
    f" FROM test_rows WHERE trip_count > 0) SELECT {half_up('t', 6)} AS test_mape, {half_up('b', 6)} AS baseline_mape,"
    f" {half_up('b - t', 6)} AS mape_vs_baseline, b - t > 0 AS beats_baseline FROM m", "test_rows"))
def _gain(spark, sf_dir):
    """Trailing-week mean as the model, week lag as the baseline."""
    y = F.col("trip_count").cast("double")
    both = test_of(spark, sf_dir).agg(
        evaluation.mape(y, F.col("rolling_168h_avg_trip_count")).alias("test_mape"), evaluation.mape(y, F.col("lag_168h_trip_count")).alias("baseline_mape"))
    return rounded(evaluation.baseline_gain(both), ["test_mape", "baseline_mape", "mape_vs_baseline"])


def _segment(spark, sf_dir, group):
    return rounded(evaluation.segment_errors(evaluation.naive_week_lag(test_of(spark, sf_dir)), group), ["mape"])


def _segment_sql(group: str) -> str:
    return (
        f"SELECT CAST({group} AS BIGINT) AS {group}, {half_up('avg(CASE WHEN trip_count > 0 THEN abs((trip_count - lag_168h_trip_count)/trip_count) END)*100', 6)}"
        f" AS mape, count(*) AS n_rows FROM test_rows GROUP BY {group}"
    )


@register("error_by_hour", oracle.sql(_segment_sql("hour_of_day"), "test_rows"))
def _by_hour(spark, sf_dir):
    return _segment(spark, sf_dir, "hour_of_day")


@register("error_by_zone_worst", oracle.sql(
    f"SELECT * FROM ({_segment_sql('pu_location_id')}) ORDER BY mape DESC, pu_location_id LIMIT 20", "test_rows"))
def _worst(spark, sf_dir):
    """Twenty zones with the largest error."""
    return evaluation.worst_segments(_segment(spark, sf_dir, "pu_location_id"), "pu_location_id")


@register("residuals", oracle.sql(
    "SELECT CAST(pu_location_id AS BIGINT) AS pu_location_id, " + TS.format("pickup_hour") + ", CAST(trip_count AS DOUBLE) AS actual,"
    " lag_168h_trip_count AS predicted, trip_count - lag_168h_trip_count AS residual FROM test_rows", "test_rows"))
def _residuals(spark, sf_dir):
    return evaluation.residuals(evaluation.naive_week_lag(test_of(spark, sf_dir)), KEYS)


@register("chart_rows", oracle.sql(
    "SELECT CAST(pu_location_id AS BIGINT) AS pu_location_id, " + TS.format("pickup_hour") + ", CAST(trip_count AS DOUBLE) AS actual,"
    " lag_168h_trip_count AS predicted, trip_count - lag_168h_trip_count AS residual FROM test_rows t ORDER BY t.pu_location_id, t.pickup_hour LIMIT 500", "test_rows"))
def _chart(spark, sf_dir):
    return evaluation.chart_rows(evaluation.residuals(evaluation.naive_week_lag(test_of(spark, sf_dir)), KEYS), KEYS)


@register("sampled_rows", oracle.sql(
    "SELECT CAST(pu_location_id AS BIGINT) AS pu_location_id, " + TS.format("pickup_hour") + ", "
    + ", ".join(c for c in FEATURES if c not in KEYS)
    + " FROM test_rows t ORDER BY md5('42|' || t.pu_location_id || '|' || strftime(t.pickup_hour, '%Y-%m-%d %H:%M:%S')),"
    " t.pu_location_id, t.pickup_hour LIMIT 100", "test_rows"))
def _sample(spark, sf_dir):
    """100 test rows without replacement, the same for any partitioning."""
    return evaluation.sample_rows(test_of(spark, sf_dir), KEYS, 100).select(*KEYS, *[c for c in FEATURES if c not in KEYS])


_BASE_ROWS = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS feature, {half_up(f'avg({c})', 6)} AS mean, {half_up(f'stddev_samp({c})', 6)} AS std FROM split WHERE split = 'train'"
    for i, c in enumerate(FEATURES)
)


@register("feature_baseline", oracle.sql(_BASE_ROWS, "split"))
def _baseline(spark, sf_dir):
    """Mean and sample deviation of every feature on the training rows."""
    train = splits.assign_split(complete_of(spark, sf_dir), SPLITS).filter(F.col("split") == "train")
    return rounded(features.feature_baseline(train), ["mean", "std"])


@register("null_rates", oracle.sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {half_up(f'avg(CASE WHEN {c} IS NULL THEN 1.0E0 ELSE 0.0E0 END)', 9)} AS null_rate FROM matrix" for c in FEATURES), "matrix"))
def _null_rates(spark, sf_dir):
    return rounded(quality.null_rates(matrix_of(spark, sf_dir)), ["null_rate"], 9)


@register("duplicate_rows", oracle.sql(
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM hourly GROUP BY pickup_hour, pu_location_id)", "hourly"))
def _duplicates(spark, sf_dir):
    """Rows beyond the first per hour and zone before vendors are collapsed."""
    return quality.duplicate_rows(hourly_of(spark, sf_dir), ["pickup_hour", "pu_location_id"])


@register("matrix_checks", oracle.sql(
    "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS negative_targets,"
    f" strftime(max(CASE WHEN pickup_hour <= TIMESTAMP '{SPLITS.train_end} 00:00:00' THEN pickup_hour END), '%Y-%m-%d %H:%M:%S') AS last_train_time, "
    + ", ".join(f"{half_up(f'avg(CASE WHEN {c} IS NULL THEN 1.0E0 ELSE 0.0E0 END)', 9)} AS null_rate_{c}" for c in FEATURES) + " FROM matrix", "matrix"))
def _checks(spark, sf_dir):
    """All feature-matrix checks in one job."""
    return rounded(quality.matrix_checks(matrix_of(spark, sf_dir), SPLITS.train_end), [f"null_rate_{c}" for c in FEATURES], 9)


@register("sequence_windows", oracle.sql(
    "SELECT strftime(pickup_hour, '%Y-%m-%d %H:%M:%S') AS pickup_hour, CAST(pu_location_id AS BIGINT) AS pu_location_id, trip_count AS target,"
    " n AS steps, first_lag, lag_sum FROM (SELECT *, count(*) OVER w AS n, first_value(lag_1h_trip_count) OVER w AS first_lag,"
    " sum(lag_1h_trip_count) OVER w AS lag_sum FROM complete WINDOW w AS (PARTITION BY pu_location_id ORDER BY pickup_hour"
    " ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)) WHERE n = 24", "complete"))
def _sequences(spark, sf_dir):
    """24-step feature sequences, summarised for the comparison."""
    seq = features.sequences(complete_of(spark, sf_dir), 24)
    lag = FEATURES.index("lag_1h_trip_count")
    return seq.select(
        "pickup_hour", "pu_location_id", "target", F.size("sequence").alias("steps"), F.col("sequence")[0][lag].alias("first_lag"),
        F.aggregate("sequence", F.lit(0.0), lambda acc, step: acc + step[lag]).alias("lag_sum"))


@register("feature_cache", oracle.sql(
    "SELECT pickup_borough, count(*) AS n_rows, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM complete GROUP BY 1", "complete"))
def _cache(spark, sf_dir):
    """The matrix computed once, saved, and read by the second call."""
    from ..session import scratch_path

    path = scratch_path(spark, "matrix-cache")
    tables.cached(spark, path, lambda: complete_of(spark, sf_dir))
    again = tables.cached(spark, path, lambda: complete_of(spark, sf_dir).limit(0))
    return again.groupBy("pickup_borough").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("trip_count").alias("trip_count"))


# --------------------------------------------------------------------------- ranks and blends
_PREDS = ["lag_168h_trip_count", "rolling_24h_avg_trip_count", "seasonal"]


def _with_preds(spark, sf_dir):
    seasonal = evaluation.seasonal_naive(test_of(spark, sf_dir)).withColumnRenamed("prediction", "seasonal")
    return seasonal.select(*KEYS, "trip_count", *_PREDS)


@register("normalised_rank", oracle.sql(
    "SELECT CAST(pu_location_id AS BIGINT) AS pu_location_id, " + TS.format("pickup_hour") + ","
    f" {half_up('(row_number() OVER (ORDER BY rolling_24h_avg_trip_count, t.pu_location_id, t.pickup_hour) - 1)/CAST(greatest(count(*) OVER () - 1, 1) AS DOUBLE)', 9)}"
    " AS rank_share FROM complete t", "complete"))
def _rank(spark, sf_dir):
    """Global rank share of one column over all rows, without a single-task window."""
    ranked = windows.normalised_rank(complete_of(spark, sf_dir).select(*KEYS, "rolling_24h_avg_trip_count"), "rolling_24h_avg_trip_count", KEYS)
    return rounded(ranked.select(*KEYS, "rank_share"), ["rank_share"], 9)


@register("weighted_blend", oracle.sql(
    "SELECT CAST(pu_location_id AS BIGINT) AS pu_location_id, " + TS.format("pickup_hour") + ","
    f" {half_up('lag_168h_trip_count*0.5E0 + rolling_24h_avg_trip_count*0.3E0 + seasonal*0.2E0', 9)} AS blend FROM naive", "naive"))
def _blend(spark, sf_dir):
    return rounded(_with_preds(spark, sf_dir).select(*KEYS, ensembles.weighted_blend(_PREDS, [0.5, 0.3, 0.2]).alias("blend")), ["blend"], 9)


@register("rank_average", oracle.sql(
    """, r AS (SELECT *, count(*) OVER () AS n, (lag_168h_trip_count + rolling_24h_avg_trip_count + seasonal)/3 AS mean_pred,
      row_number() OVER (ORDER BY lag_168h_trip_count, pu_location_id, pickup_hour) - 1 AS r0,
      row_number() OVER (ORDER BY rolling_24h_avg_trip_count, pu_location_id, pickup_hour) - 1 AS r1,
      row_number() OVER (ORDER BY seasonal, pu_location_id, pickup_hour) - 1 AS r2 FROM naive),
    s AS (SELECT mean_pred AS v, row_number() OVER (ORDER BY mean_pred, pu_location_id, pickup_hour) - 1 AS position FROM r),
    q AS (SELECT *, CAST(round_even((CAST(r0 AS DOUBLE)/greatest(n-1,1) + CAST(r1 AS DOUBLE)/greatest(n-1,1) + CAST(r2 AS DOUBLE)/greatest(n-1,1))/3*(n-1), 0) AS BIGINT) AS target FROM r)
    SELECT CAST(q.pu_location_id AS BIGINT) AS pu_location_id, strftime(q.pickup_hour, '%Y-%m-%d %H:%M:%S') AS pickup_hour, """
    + half_up("greatest(s.v, 0)", 9) + " AS prediction FROM q JOIN s ON s.position = least(greatest(q.target, 0), q.n - 1)", "naive"))
def _rank_average(spark, sf_dir):
    """Average of global ranks mapped back to the sorted mean predictions."""
    out = ensembles.rank_average(materialise(_with_preds(spark, sf_dir), "predictions"), _PREDS, KEYS)
    return rounded(out.select(*KEYS, "prediction"), ["prediction"], 9)


# --------------------------------------------------------------------------- monitoring and anomalies
def _forecast(hourly):
    first, last = splits.scoring_window(RUN_DATE)
    rows = features.complete_rows(features.build_feature_matrix(hourly, first, last, lookback_hours=24 * 60))
    shifted = F.expr("CAST(pickup_hour + make_dt_interval(0, pu_location_id % 2) AS TIMESTAMP_NTZ)")
    return rows.select(
        shifted.alias("pickup_hour"), "pu_location_id", F.col("lag_168h_trip_count").alias("predicted_trip_count"), F.lit(RUN_DATE).alias("_run_date"))


block(
    "forecast",
    "SELECT pickup_hour + INTERVAL 1 HOUR * (pu_location_id % 2) AS pickup_hour, pu_location_id, lag_168h_trip_count AS pred FROM ("
    + _features_sql(
        "(SELECT * FROM panel WHERE pickup_hour >= TIMESTAMP '2025-04-02 00:00:00' AND pickup_hour < TIMESTAMP '2025-07-01 00:00:00')", "2025-06-01"
    )
    + ") WHERE lag_168h_trip_count IS NOT NULL",
    "panel",
)


@register("forecast_accuracy", oracle.sql(
    f"SELECT {half_up('avg(abs(trip_count - pred))', 6)} AS mae, {half_up('sqrt(avg((trip_count - pred)*(trip_count - pred)))', 6)} AS rmse,"
    f" {half_up('avg(abs((trip_count - pred)/trip_count))*100', 6)} AS mape, (SELECT count(*) FROM forecast) AS n_predictions, count(*) AS n_actuals"
    " FROM forecast JOIN panel USING (pickup_hour, pu_location_id) WHERE pickup_hour >= TIMESTAMP '2025-06-01 00:00:00' AND pickup_hour < TIMESTAMP '2025-07-01 00:00:00'",
    "forecast", "panel"))
def _accuracy(spark, sf_dir):
    """A forecast of which half the zones are an hour off, so some rows have no actual."""
    first, last = splits.scoring_window(RUN_DATE)
    hourly = materialise(hourly_of(spark, sf_dir), "hourly")
    out = monitoring.forecast_accuracy(_forecast(hourly), hourly, RUN_DATE, first, last)
    return rounded(out, ["mae", "rmse", "mape"])


@register("degradation_flags", oracle.sql(
    f", m AS (SELECT pu_location_id, avg(abs((trip_count - lag_168h_trip_count)/trip_count))*100 AS c, avg(abs((trip_count - seasonal)/trip_count))*100 AS t,"
    " avg(abs((trip_count - rolling_24h_avg_trip_count)/trip_count))*100 AS b FROM naive GROUP BY 1)"
    f" SELECT CAST(pu_location_id AS BIGINT) AS pu_location_id, {half_up('c', 6)} AS mape, c > t*1.2E0 OR c > b AS mape_degraded FROM m", "naive"))
def _degraded(spark, sf_dir):
    """Per zone: week lag against seasonal naive (training error) and day mean (baseline)."""
    y = F.col("trip_count").cast("double")
    per_zone = _with_preds(spark, sf_dir).groupBy("pu_location_id").agg(
        *[evaluation.mape(y, F.col(c)).alias(n) for c, n in zip(_PREDS, ("mape", "_baseline", "_training"))])
    flagged = per_zone.withColumn("mape_degraded", monitoring.degraded(F.col("mape"), F.col("_training"), F.col("_baseline")))
    return rounded(flagged.select("pu_location_id", "mape", "mape_degraded"), ["mape"])


_DRIFT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({i + 1} AS BIGINT) AS position, (SELECT avg({c}) FROM split WHERE split = 'test') AS cur, avg({c}) AS m, stddev_samp({c}) AS s FROM split WHERE split = 'train'"
    for i, c in enumerate(FEATURES)
)


def _drift(spark, sf_dir, sigma=monitoring.DRIFT_SIGMA):
    rows = splits.assign_split(complete_of(spark, sf_dir), SPLITS)
    baseline = features.feature_baseline(rows.filter(F.col("split") == "train"))
    return monitoring.feature_drift(rows.filter(F.col("split") == "test"), baseline, sigma=sigma)


@register("feature_drift", oracle.sql(
    f", d AS ({_DRIFT_SQL}) SELECT feature, position, {half_up('cur', 6)} AS current_mean, {half_up('m', 6)} AS base_mean, {half_up('s', 6)} AS base_std,"
    " abs(cur - m) > 2*s AS drifted FROM d WHERE s <> 0", "split"))
def _drift_table(spark, sf_dir):
    return rounded(_drift(spark, sf_dir), ["current_mean", "base_mean", "base_std"])


@register("drift_summary", oracle.sql(
    f", d AS ({_DRIFT_SQL}) SELECT COALESCE(string_agg(feature, ',' ORDER BY position) FILTER (WHERE abs(cur - m) > 0.25E0*s), '') AS drifted_features,"
    " count(*) FILTER (WHERE abs(cur - m) > 0.25E0*s) AS n_drifted_features FROM d WHERE s <> 0", "split"))
def _drift_summary(spark, sf_dir):
    """Names of drifted features at a quarter deviation, the limit at which this data shows some."""
    return monitoring.drift_summary(_drift(spark, sf_dir, 0.25))


def _z_sql(m: str) -> str:
    w = "OVER (PARTITION BY pu_location_id ORDER BY pickup_date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)"
    return f"CASE WHEN stddev_samp({m}) {w} > 0 THEN ({m} - avg({m}) {w})/stddev_samp({m}) {w} END"


@register("zone_day_anomalies", oracle.sql(
    f", z AS (SELECT *, {_z_sql('trip_count')} AS z1, {_z_sql('total_revenue')} AS z2 FROM daily)"
    " SELECT strftime(pickup_date, '%Y-%m-%d') AS anomaly_date, CAST(pu_location_id AS BIGINT) AS pu_location_id, pickup_borough, trip_count,"
    f" {half_up('z1', 6)} AS z_score, {half_up('z2', 6)} AS revenue_z_score, COALESCE(z1 > 3.0E0, false) AS is_anomaly FROM z", "daily"))
def _anomalies(spark, sf_dir):
    """z-scores against the 30 calendar days before."""
    return rounded(anomaly.score_days(daily_of(spark, sf_dir)), ["z_score", "revenue_z_score"])
