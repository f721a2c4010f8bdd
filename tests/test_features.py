"""Features, splits, errors and ranks against hand-computed rows and brute force."""

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.operators import anomaly, ensembles, evaluation, features, monitoring, quality, splits, windows
from faremill.schema import PanelSpec

SPEC = PanelSpec(exogenous=None, group=None)
T0 = datetime(2024, 1, 1)


def panel(spark, series):
    rows = [(z, T0 + timedelta(hours=h), n) for z, points in series.items() for h, n in points]
    return spark.createDataFrame(rows, "pu_location_id int, pickup_hour timestamp_ntz, trip_count bigint")


def test_row_lag_and_hour_lag(spark):
    df = panel(spark, {1: [(0, 5), (1, 6), (5, 7)]})
    rows = {r.pickup_hour.hour: r for r in features.row_lag_features(df, SPEC).collect()}
    hours = {r.pickup_hour.hour: r for r in features.hour_lag_features(df, SPEC).collect()}
    assert rows[5].lag_1h_trip_count == 6.0 and hours[5].lag_1h_trip_count is None and hours[1].lag_1h_trip_count == 5.0


def test_trailing_mean(spark):
    df = panel(spark, {1: [(0, 1), (1, 2), (2, 3), (3, 4)]})
    got = [r.rolling_24h_avg_trip_count for r in features.row_lag_features(df, SPEC).orderBy("pickup_hour").collect()]
    assert got == [None, 1.0, 1.5, 2.0]


def _random_panel(spark, n=700, seed=3):
    rng = np.random.default_rng(seed)
    series = {z: [(int(h), int(rng.integers(0, 50))) for h in np.sort(rng.choice(3 * n, n, replace=False))] for z in (1, 2)}
    series[3] = [(5, 9)]
    return panel(spark, series), series


def test_chunked_features_equal_unchunked_and_brute_force(spark):
    df, series = _random_panel(spark)
    plain = sorted(features.row_lag_features(df, SPEC).select("pu_location_id", "pickup_hour", *_names()).collect())
    chunked = sorted(features.row_lag_features(df, SPEC, rows_per_chunk=170).select("pu_location_id", "pickup_hour", *_names()).collect())
    assert str(plain) == str(chunked)
    by_key = {(r[0], r[1]): r for r in plain}
    for z, points in series.items():
        values = [v for _, v in points]
        for i, (h, _) in enumerate(points):
            r = by_key[(z, T0 + timedelta(hours=h))]
            assert r.lag_168h_trip_count == (values[i - 168] if i >= 168 else None)
            for k in (24, 168):
                past = values[max(0, i - k) : i]
                expected = sum(past) / len(past) if past else None
                assert r[f"rolling_{k}h_avg_trip_count"] == expected


def _names():
    return ["lag_1h_trip_count", "lag_24h_trip_count", "lag_168h_trip_count", "rolling_24h_avg_trip_count", "rolling_168h_avg_trip_count"]


def test_hour_chunks_equal_unchunked(spark):
    df, _ = _random_panel(spark, 300)
    a = sorted(map(str, features.hour_lag_features(df, SPEC).select("pu_location_id", "pickup_hour", *_names()).collect()))
    b = sorted(map(str, features.hour_lag_features(df, SPEC, hours_per_chunk=200).select("pu_location_id", "pickup_hour", *_names()).collect()))
    assert a == b


def test_features_never_read_the_present_or_future(spark):
    df, _ = _random_panel(spark, 60)
    cut = T0 + timedelta(hours=90)
    changed = df.withColumn("trip_count", F.when(F.col("pickup_hour") >= F.lit(str(cut)).cast("timestamp_ntz"), F.col("trip_count") + 1000).otherwise(F.col("trip_count")))
    keep = F.col("pickup_hour") <= F.lit(str(cut)).cast("timestamp_ntz")
    for build in (features.row_lag_features, features.hour_lag_features):
        before, after = (sorted(map(str, build(d, SPEC).filter(keep).select("pu_location_id", "pickup_hour", *_names()).collect())) for d in (df, changed))
        assert before == after


def test_long_range_switches_to_chunks(spark):
    hourly = panel(spark, {1: [(h, 1) for h in range(400)]}).withColumn("total_congestion_fees", F.lit(0.0)).withColumn("pickup_borough", F.lit("Queens"))
    a = features.build_feature_matrix(hourly, date(2024, 1, 1), date(2024, 1, 20))
    b = features.build_feature_matrix(hourly, date(2024, 1, 1), date(2024, 1, 20), rows_per_chunk=200)
    assert "_chunk" not in a._jdf.queryExecution().analyzed().toString()
    assert "_chunk" in b._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_sequences_stay_inside_their_series(spark):
    df = panel(spark, {1: [(0, 1), (1, 2), (2, 3)], 2: [(0, 10), (1, 20), (2, 30)]})
    for chunk in (None, 2):
        got = {r.pu_location_id: r.sequence for r in features.sequences(df, 2, ["trip_count"], SPEC, chunk).collect()}
        assert got == {1: [[1.0], [2.0]], 2: [[10.0], [20.0]]}


def test_split_limits(spark):
    s = splits.rolling_splits(date(2026, 4, 5))
    assert (s.train_end, s.val_start, s.val_end, s.test_start, s.test_end) == (
        date(2025, 12, 31), date(2026, 1, 1), date(2026, 1, 31), date(2026, 2, 1), date(2026, 2, 28))
    stamps = [datetime(2025, 12, 31, 0), datetime(2025, 12, 31, 1), datetime(2026, 1, 31, 23)]
    df = spark.createDataFrame([(t,) for t in stamps], "pickup_hour timestamp_ntz")
    parity = [r.split for r in splits.assign_split(df, s).orderBy("pickup_hour").collect()]
    fixed = [r.split for r in splits.assign_split(df, s, mode="fixed").orderBy("pickup_hour").collect()]
    assert parity == ["train", None, None] and fixed == ["train", "train", "val"]


def test_folds_move_back_by_months():
    assert [splits.rolling_splits(date(2025, 3, 9), k).test_start for k in range(3)] == [date(2025, 1, 1), date(2024, 12, 1), date(2024, 11, 1)]


def test_seasonal_naive_skips_missing_lags(spark):
    df = spark.createDataFrame([(10.0, None, 20.0)], "lag_1h_trip_count double, lag_24h_trip_count double, lag_168h_trip_count double")
    assert evaluation.seasonal_naive(df).first().prediction == 15.0


def test_error_metrics(spark):
    df = spark.createDataFrame([(0, 5.0), (10, 8.0)], "trip_count int, prediction double")
    m = evaluation.error_metrics(df).first()
    assert m.mape == pytest.approx(20.0) and m.mae == 3.5 and m.rmse == pytest.approx(math.sqrt(14.5)) and m.n_rows == 2
    zeros = spark.createDataFrame([(0, 5.0)], "trip_count int, prediction double")
    assert math.isnan(evaluation.error_metrics(zeros).first().mape)


def test_empty_folds_are_skipped(spark):
    members = spark.createDataFrame([(0, "test", 4, 2.0)], "fold int, split string, trip_count int, lag_168h_trip_count double")
    per_fold = evaluation.walk_forward_naive(members)
    assert per_fold.count() == 0 and math.isnan(evaluation.fold_summary(per_fold).first().mape_mean)


def test_gates():
    assert evaluation.promotion(1.0, 30.0, 50.0).decision == "PROMOTE"
    assert evaluation.promotion(2.0, 30.0, 50.0).decision == "HOLD"
    assert evaluation.promotion(1.0, float("nan"), 50.0).decision == "HOLD"
    assert evaluation.gain_passes(35.0, 34.4) and not evaluation.gain_passes(35.0, 34.5)


def test_sample_is_the_same_for_any_partitioning(spark):
    df = spark.range(1000)
    a, b = (sorted(r.id for r in evaluation.sample_rows(df.repartition(n), ["id"], 50).collect()) for n in (2, 7))
    assert a == b and len(set(a)) == 50


def test_baseline_uses_sample_deviation(spark):
    row = features.feature_baseline(spark.createDataFrame([(1.0,), (3.0,)], "x double"), ["x"]).first()
    assert row["mean"] == 2.0 and row["std"] == pytest.approx(math.sqrt(2))


def test_drift_limit_is_strict_and_constant_features_are_skipped(spark):
    current = spark.createDataFrame([(5.0, 7.0, 6.0)], "a double, b double, c double")
    base = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 0.0), ("c", 1.0, 2.0)], "feature string, mean double, std double")
    drift = monitoring.feature_drift(current, base, ["c", "a", "b"])
    assert {r.feature: r.drifted for r in drift.collect()} == {"a": False, "c": True}
    assert tuple(monitoring.drift_summary(drift).first()) == ("c", 1)
    assert tuple(monitoring.drift_summary(drift.filter("feature = 'a'")).first()) == ("", 0)


def test_degradation_rules(spark):
    nan = float("nan")
    df = spark.createDataFrame([(43.0, 35.0, 50.0), (43.0, nan, 50.0), (43.0, nan, 40.0), (42.0, 35.0, nan), (41.0, None, None)], "m double, t double, b double")
    got = [r.d for r in df.select(monitoring.degraded(F.col("m"), F.col("t"), F.col("b")).alias("d")).collect()]
    assert got == [True, False, True, False, False]


def test_rank_average_of_opposite_models(spark):
    df = spark.createDataFrame([(0, 1.0, 3.0), (1, 2.0, 2.0), (2, 3.0, 1.0)], "k int, a double, b double")
    assert [r.prediction for r in ensembles.rank_average(df, ["a", "b"], ["k"]).collect()] == [2.0, 2.0, 2.0]
    assert df.select(ensembles.weighted_blend(["a", "b"]).alias("p")).first().p == 2.0


def test_rank_average_matches_array_brute_force_with_a_hot_value(spark):
    rng = np.random.default_rng(5)
    n = 600
    a, b = rng.normal(size=n).round(1), rng.normal(size=n)
    a[: n // 2] = 0.0  # half of all rows share one value
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))], "k int, a double, b double").repartition(5)
    ranks = [np.argsort(np.argsort(v, kind="stable"), kind="stable") / (n - 1) for v in (a, b)]
    blend = np.sort((a + b) / 2)
    expected = np.maximum(blend[np.rint((ranks[0] + ranks[1]) / 2 * (n - 1)).astype(int)], 0)
    got = [r.prediction for r in ensembles.rank_average(df, ["a", "b"], ["k"]).orderBy("k").collect()]
    assert np.allclose(got, expected)


def test_global_index_has_no_gaps(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), F.lit(1).alias("c")).repartition(6)
    got = windows.global_row_index(df, [F.col("c"), F.col("v")]).orderBy("v").collect()
    assert [r.row_index for r in got] == list(range(5000))


def test_anomalies(spark):
    rows = [(1, date(2024, 1, 1) + timedelta(days=i), "Queens", 5, 50.0) for i in range(31)] + [(1, date(2024, 2, 1), "Queens", 500, 50.0)]
    rows += [(2, date(2024, 1, 1) + timedelta(days=i), "Bronx", 10 + i % 2, 1.0 + i % 3) for i in range(30)] + [(2, date(2024, 1, 31), "Bronx", 40, 1.0)]
    df = spark.createDataFrame(rows, "pu_location_id int, pickup_date date, pickup_borough string, trip_count bigint, total_revenue double")
    got = {(r.pu_location_id, r.anomaly_date): r for r in anomaly.score_days(df).collect()}
    flat = got[(1, date(2024, 2, 1))]
    assert flat.z_score is None and flat.is_anomaly is False
    spike = got[(2, date(2024, 1, 31))]
    past = np.array([10 + i % 2 for i in range(30)], float)
    assert spike.is_anomaly and spike.z_score == pytest.approx((40 - past.mean()) / past.std(ddof=1))
    assert got[(2, date(2024, 1, 2))].z_score is None  # one earlier day only


def test_matrix_gate(spark):
    good = spark.createDataFrame([(1, datetime(2024, 1, 1, h), 5, 1.0) for h in range(4)], "pu_location_id int, pickup_hour timestamp_ntz, trip_count int, f double")
    args = (date(2024, 1, 2), date(2024, 1, 3))
    quality.require_matrix(good, *args, features=["f"], min_rows=4)
    for bad, kw in (
        (good, {"min_rows": 5}),
        (good.unionAll(good), {"min_rows": 1}),
        (good.withColumn("trip_count", F.lit(-1)), {"min_rows": 1}),
        (good.withColumn("f", F.lit(None).cast("double")), {"min_rows": 1}),
    ):
        with pytest.raises(quality.DataQualityError):
            quality.require_matrix(bad, *args, features=["f"], **kw)
    with pytest.raises(quality.DataQualityError):
        quality.require_matrix(good, date(2024, 1, 2), date(2024, 1, 1), features=["f"], min_rows=1)
    with pytest.raises(quality.DataQualityError):
        quality.require_matrix(good, *args, features=["g"], min_rows=1)


def test_hour_frames_of_gappy_series(spark):
    """Trailing clock-hour means against brute force, with gaps, NULL targets and several keys, whole and in chunks."""
    import random
    from datetime import datetime, timedelta

    rng, start, rows = random.Random(3), datetime(2024, 1, 1), []
    for key in (1, 2, 3):
        for h in sorted(rng.sample(range(900), 40 if key == 1 else 500)):
            rows.append((key, start + timedelta(hours=h), None if rng.random() < 0.1 else rng.randrange(50), 1.0))
    df = spark.createDataFrame(rows, "pu_location_id int, pickup_hour timestamp_ntz, trip_count long, total_congestion_fees double")
    value = {(k, t): v for k, t, v, _ in rows}
    for chunk in (None, 200):
        for r in features.hour_lag_features(df, hours_per_chunk=chunk).collect():
            for n in (24, 168):
                seen = [v for i in range(1, n + 1) if (v := value.get((r.pu_location_id, r.pickup_hour - timedelta(hours=i)))) is not None]
                got = r[f"rolling_{n}h_avg_trip_count"]
                assert got == (sum(seen) / len(seen) if seen else None)
            assert r["lag_24h_trip_count"] == value.get((r.pu_location_id, r.pickup_hour - timedelta(hours=24)))
