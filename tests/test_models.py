"""Models against closed forms; policy regression against dense least squares."""

import math
from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.operators import ensembles, evaluation, models, monitoring, policy
from faremill.operators.registry import ModelRegistry
from faremill.plans import forecast
from faremill.schema import PolicySpec
from faremill.session import scratch_path

RNG = np.random.default_rng(11)
X = np.column_stack([RNG.normal(5, 3, 400), RNG.normal(-1, 0.2, 400), RNG.integers(0, 9, 400)]).astype(float)
Y = np.maximum(20 + X @ np.array([1.5, -8.0, 0.7]) + RNG.normal(0, 2, 400), 0)
NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def table(spark):
    rows = [(*map(float, x), float(y), i) for i, (x, y) in enumerate(zip(X, Y))]
    return spark.createDataFrame(rows, "a double, b double, c double, trip_count double, k int")


@pytest.mark.parametrize("alpha", [1.0, 250.0])
def test_ridge_on_standardised_features(table, alpha):
    z = (X - X.mean(0)) / X.std(0)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (Y - Y.mean()))
    expected = np.maximum(z @ w + Y.mean(), 0)
    got = [r.prediction for r in models.ridge(alpha, NAMES).fit(table).predict(table).orderBy("k").collect()]
    assert np.allclose(got, expected, rtol=1e-6)


@pytest.mark.parametrize("alpha", [1.0, 250.0])
def test_stacking_ridge_without_standardisation(table, alpha):
    c = X - X.mean(0)
    w = np.linalg.solve(c.T @ c + alpha * np.eye(3), c.T @ (Y - Y.mean()))
    expected = np.maximum(c @ w + Y.mean(), 0)
    got = [r.prediction for r in ensembles.stack(table, NAMES, alpha).predict(table).orderBy("k").collect()]
    assert np.allclose(got, expected, rtol=1e-6)


def test_boosting_is_deterministic_learns_and_clips(table):
    train, val = table.filter("k % 4 <> 0"), table.filter("k % 4 = 0")
    spec = models.boosted_log(NAMES, maxIter=15, maxDepth=3, minInstancesPerNode=5)
    first = spec.fit(train, val)
    a, b = (sorted(r.prediction for r in m.predict(val).collect()) for m in (first, spec.fit(train, val)))
    assert a == b and min(a) >= 0
    mean = train.agg(F.avg("trip_count")).first()[0]
    error = evaluation.error_metrics(first.predict(val)).first().mae
    constant = evaluation.error_metrics(val.withColumn("prediction", F.lit(mean))).first().mae
    noise = 2 * math.sqrt(2 / math.pi)  # mean absolute value of the generated noise
    assert error - noise < (constant - noise) / 2
    top = first.importances(table.sparkSession).collect()
    assert {r.feature for r in top} == set(NAMES) and sum(r.importance for r in top) == pytest.approx(1.0)


def test_ablation_reuses_equal_subsets(table):
    fits = []

    def make(subset):
        fits.append(subset)
        return models.ridge(1.0, subset)

    sets = {"full": NAMES, "same": NAMES, "one": ("a",), "unknown": ("zz",)}
    rows = models.ablation(sets, make, table, table, table)
    assert [r["variant"] for r in rows] == ["full", "same", "one"] and len(fits) == 2
    assert rows[0]["test_mape"] == rows[1]["test_mape"]


def test_search_is_seeded_and_ranked(table):
    assert models.search_trials(4) == models.search_trials(4)
    trials = [{"maxDepth": 1}, {"maxDepth": 4}]
    rows = models.search(trials, table, table, table, features=NAMES, maxIter=5, minInstancesPerNode=5)
    assert [r["val_mape"] for r in rows] == sorted(r["val_mape"] for r in rows) and rows[0]["trial"] == 1


def test_registry(spark, table):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    with pytest.raises(RuntimeError):
        registry.load("demand")
    model = models.ridge(1.0, NAMES).fit(table)
    assert registry.register("demand", model, date(2025, 8, 5), {"test_mape": 3.5}) == 1
    assert registry.register("demand", model, date(2025, 9, 5), {"test_mape": 3.0}) == 2
    with pytest.raises(RuntimeError):
        registry.load("demand", "production")
    registry.set_alias("demand", "Production", 1)
    loaded, version = registry.load("demand")
    assert version == 1 and registry.resolve("demand", "staging").version == 2
    assert registry.resolve("demand").metrics["test_mape"] == 3.5
    a, b = ([r.prediction for r in m.predict(table).orderBy("k").collect()] for m in (loaded, model))
    assert a == b
    with pytest.raises(ValueError):
        registry.set_alias("demand", "canary", 1)


# --------------------------------------------------------------------------- policy regression
SPEC = PolicySpec()
ZONES = [(1, "Manhattan", "Yellow Zone"), (2, "Manhattan", "Yellow Zone"), (3, "Queens", "Boro Zone"), (4, "Bronx", "Boro Zone"),
         (5, "Brooklyn", "Boro Zone"), (6, "Staten Island", "Boro Zone"), (7, "Manhattan", "Boro Zone")]


def daily_rows(spark, value, first=date(2024, 11, 1), days=150):
    rows = []
    for z, borough, service in ZONES:
        for i in range(days):
            d = first + timedelta(days=i)
            if (z + i) % 11 == 0:
                continue  # unbalanced panel
            y = value(z, d, borough == "Manhattan" and service == "Yellow Zone")
            rows.append((d, d.strftime("%a"), z, borough, service, float(y), float(y) * 10, 0.0))
    return spark.createDataFrame(
        rows, "pickup_date date, day_of_week string, pu_location_id int, pickup_borough string, service_zone string,"
        " trip_count double, total_revenue double, total_congestion_fees double")  # fmt: skip


def study(spark, value, run=date(2025, 8, 1), spec=SPEC, **kw):
    rows = policy.study_rows(daily_rows(spark, value, **kw), run, spec)
    return rows, policy.zone_count(rows)


def test_exact_effect_is_recovered(spark):
    def value(z, d, treated):
        post = d >= SPEC.effective
        return 100 * z + 3 * d.weekday() - 7 * post + 5 * (post and treated)

    rows, n = study(spark, value)
    assert n == 5  # Staten Island and Manhattan outside the treated service zone are in neither arm
    fit = policy.fit_effect(rows, "trip_count", n)
    assert fit.effect()[0] == pytest.approx(5.0) and fit.effect("post")[0] == pytest.approx(-7.0)
    assert fit.r_squared == pytest.approx(1.0)


def _dense(rows, outcome):
    pdf = rows.toPandas()
    zones, days = sorted(pdf.pu_location_id.unique()), sorted(pdf.day_of_week.unique())
    columns = [np.ones(len(pdf)), pdf.post, pdf.post_treated]
    columns += [(pdf.pu_location_id == z) for z in zones[1:]] + [(pdf.day_of_week == d) for d in days[:-1]]
    x = np.column_stack([np.asarray(c, float) for c in columns])
    y = pdf[outcome].to_numpy(float)
    beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=None)
    ssr = float(((y - x @ beta) ** 2).sum())
    dof = len(y) - rank
    se = math.sqrt(ssr / dof * np.linalg.pinv(x.T @ x)[2, 2])
    return beta[2], beta[2] / se, dof, 1 - ssr / float(((y - y.mean()) ** 2).sum())


def test_fit_equals_dense_least_squares(spark):
    rng = np.random.default_rng(2)
    noise = {}

    def value(z, d, treated):
        return 50 * z + noise.setdefault((z, d), rng.normal(0, 4)) + 1.0 * (treated and d >= SPEC.effective) + d.weekday()

    rows, n = study(spark, value)
    for outcome in ("trip_count", "total_revenue"):
        fit = policy.fit_effect(rows, outcome, n)
        beta, t, dof, r2 = _dense(rows, outcome)
        assert fit.effect()[0] == pytest.approx(beta, rel=1e-8)
        assert fit.effect()[1] == pytest.approx(policy.student_t_two_sided(t, dof), rel=1e-6)
        assert fit.r_squared == pytest.approx(r2, rel=1e-9)
        cube = policy.effect_cube(rows, ("trip_count", "total_revenue"))
        assert policy.zone_count(cube) == n
        assert policy.solve(policy.cross_products(policy.cells_of(cube, outcome)), n).effect() == pytest.approx(fit.effect(), rel=1e-9)


def test_clustered_errors_equal_a_dense_sandwich(spark):
    rng = np.random.default_rng(7)
    noise, drift = {}, {}

    def value(z, d, treated):
        shock = drift.setdefault((z, d.month), rng.normal(0, 6))
        return 50 * z + shock + noise.setdefault((z, d), rng.normal(0, 4)) + 1.0 * (treated and d >= SPEC.effective) + d.weekday()

    rows, n = study(spark, value)
    got = policy.clustered_fit(policy.effect_cells(rows, "trip_count"), n)
    pdf = rows.toPandas()
    days = sorted(pdf.day_of_week.unique())
    x = np.column_stack([pdf.post, pdf.post_treated, *[(pdf.day_of_week == d) for d in days[:-1]]]).astype(float)
    y, zone = pdf.trip_count.to_numpy(float), pdf.pu_location_id.to_numpy()
    for z in np.unique(zone):
        x[zone == z] -= x[zone == z].mean(0)
        y[zone == z] -= y[zone == z].mean()
    inverse = np.linalg.pinv(x.T @ x)
    beta = inverse @ x.T @ y
    scores = np.array([x[zone == z].T @ (y - x @ beta)[zone == z] for z in np.unique(zone)])
    rank = np.linalg.matrix_rank(x)
    variance = (inverse @ scores.T @ scores @ inverse)[1, 1] * n / (n - 1) * (len(y) - 1) / (len(y) - rank)
    at = got.fit.names.index(policy.INTERACTION)
    assert got.fit.beta[at] == pytest.approx(beta[1], rel=1e-8)
    assert got.std_error[at] == pytest.approx(math.sqrt(variance), rel=1e-6)
    assert got.p_value[at] == pytest.approx(policy.student_t_two_sided(beta[1] / math.sqrt(variance), n - 1), rel=1e-6)


def test_student_t_tail():
    # Two degrees of freedom have a closed form; large ones approach the normal tail.
    for t in (0.1, 1.0, 4.3, 30.0):
        assert policy.student_t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
    assert policy.student_t_two_sided(1.96, 1e7) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-5)
    assert 0 < policy.student_t_two_sided(21.0, 9000) < 1e-90


def test_placebo_and_no_post_rows(spark):
    def flat(z, d, treated):
        return 10 * z + d.weekday()

    placebo = replace(SPEC, effective=date(2024, 12, 1))
    rows, n = study(spark, flat, run=SPEC.effective, spec=placebo)
    assert policy.fit_effect(rows, "trip_count", n, placebo).effect()[0] == pytest.approx(0.0, abs=1e-9)
    rows, n = study(spark, flat, run=SPEC.effective)
    assert policy.fit_effect(rows, "trip_count", n).effect() == (0.0, None)


def test_event_study_finds_the_month(spark):
    def value(z, d, treated):
        return 10 * z + 6 * (treated and (d.year, d.month) == (2025, 2))

    rows, n = study(spark, value)
    fit = policy.fit_event_study(rows, "trip_count", n)
    effects = {name: fit.effect(name)[0] for name in fit.names if name.startswith("treated_")}
    assert effects.pop("treated_2025-02") == pytest.approx(6.0)
    assert all(abs(v) < 1e-8 for v in effects.values()) and "treated_2024-12" not in fit.names


def test_run_date_is_exclusive(spark):
    rows = policy.study_rows(daily_rows(spark, lambda z, d, t: 1), date(2024, 11, 3))
    assert rows.agg(F.max("pickup_date")).first()[0] == date(2024, 11, 2)
    with pytest.raises(ValueError):
        policy.impact_table(daily_rows(spark, lambda z, d, t: 1), date(2024, 1, 1))


def test_best_round_waits_for_the_patience():
    assert models.best_round([5.0, 4.0, 4.5, 4.4, 3.0], 3) == 5
    assert models.best_round([5.0, 4.0, 4.5, 4.4, 4.3, 3.0], 3) == 2
    assert models.best_round([2.0], 50) == 1


def test_early_stop_keeps_a_prefix_of_the_trees(table):
    spec = models.boosted_log(NAMES, maxIter=12, maxDepth=2, minInstancesPerNode=5)
    whole, cut = spec.fit(table).pipeline.stages[1], spec.fit(table, table.filter("trip_count > 0").limit(5)).pipeline.stages[1]
    n = cut.getNumTrees
    assert 1 <= n <= 12
    assert [x.toDebugString.split("\n", 1)[1] for x in cut.trees] == [x.toDebugString.split("\n", 1)[1] for x in whole.trees[:n]]


def test_monitoring_goes_on_without_a_baseline(spark):
    drift = monitoring.drift_summary(monitoring.feature_drift(spark.range(3).selectExpr("id AS a"), spark.createDataFrame([], forecast._BASELINE), ["a"]))
    assert drift.first()[:] == ("", 0)


def test_simplex_least_squares_against_all_supports():
    """The best weights are least squares on some set of donors: compared with all sets."""
    from itertools import combinations

    from faremill.operators import synthetic

    rng = np.random.default_rng(5)
    for trial in range(12):
        a, b = rng.normal(0, 1, (9, 5)), rng.normal(0, 1, 9)
        best = math.inf
        for size in range(1, 6):
            for chosen in combinations(range(5), size):
                part = a[:, chosen]
                system = np.block([[part.T @ part, np.ones((size, 1))], [np.ones((1, size)), np.zeros((1, 1))]])
                w = np.linalg.lstsq(system, np.append(part.T @ b, 1.0), rcond=None)[0][:-1]
                if (w >= -1e-12).all():
                    best = min(best, float(((part @ w - b) ** 2).sum()))
        w = synthetic.simplex_least_squares(a, b)
        assert (w >= 0).all() and w.sum() == pytest.approx(1) and float(((a @ w - b) ** 2).sum()) == pytest.approx(best, rel=1e-6)
    assert synthetic.on_simplex(np.array([0.2, 0.3])).tolist() == pytest.approx([0.45, 0.55])


def test_synthetic_control_finds_the_mix_and_the_effect(spark):
    from faremill.operators import synthetic

    rng = np.random.default_rng(6)
    level = {}

    def value(z, d, treated):
        week = d.toordinal() // 7
        return level.setdefault((z, week), int(rng.integers(50, 200)))

    rows, _ = study(spark, value)
    series = synthetic.weekly_series(rows, "trip_count").collect()
    donors = sorted({r.pu_location_id for r in series if r.treated == 0})
    mix = dict(zip(donors, [0.7, 0.3] + [0.0] * len(donors)))
    by = {(r.pu_location_id, r.week): r.value for r in series}
    made = [(r.pu_location_id, r.treated, r.week, r.value if r.treated == 0 else sum(w * by[z, r.week] for z, w in mix.items()) + 40.0 * (r.week >= SPEC.effective)) for r in series]
    frame = spark.createDataFrame(made, "pu_location_id int, treated int, week date, value double")
    weights = {r.pu_location_id: r.weight for r in synthetic.donor_weights(frame).collect()}
    assert all(weights[z] == pytest.approx(w, abs=1e-4) for z, w in mix.items() if z in weights)
    gaps = synthetic.gap_series(frame, synthetic.donor_weights(frame)).collect()
    assert all(g.gap == pytest.approx(40.0 if g.post else 0.0, abs=0.5) for g in gaps) and {g.post for g in gaps} == {True, False}


def test_matrix_gate_does_not_count_vendors(spark):
    """Every zone-hour served by six vendors: the matrix has a row a zone and hour, and passes its gate."""
    from faremill.operators.quality import require_matrix
    from faremill.plans.queries_models import _least_rows

    hours = spark.range(400).select(F.expr("CAST(TIMESTAMP_NTZ '2025-04-20 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS TIMESTAMP_NTZ)").alias("pickup_hour"))
    hourly = hours.crossJoin(spark.range(3).selectExpr("CAST(id AS INT) AS pu_location_id")).crossJoin(spark.range(6).selectExpr("id AS vendor_id"))
    hourly = hourly.withColumns({"pickup_borough": F.lit("Queens"), "trip_count": F.lit(2).cast("bigint"), "total_congestion_fees": F.lit(0.5)})
    run = date(2025, 7, 5)
    matrix = forecast.training_matrix(hourly, run)
    require_matrix(matrix, date(2025, 3, 31), date(2025, 4, 1), min_rows=_least_rows(hourly))
    assert matrix.count() == 3 * (400 - 168) and _least_rows(hourly) == 300


def test_a_fit_stops_growing_once_its_best_round_is_known(spark, table, monkeypatch):
    """Trees of noise get worse from the start: no round beyond the patience is grown, and the saved model keeps its trees."""
    from pyspark.ml.regression import GBTRegressor

    grown, fit = [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: grown.append(self.getMaxIter()) or fit(self, df))
    noise = table.withColumn("trip_count", F.abs(F.hash("k")) % 50)
    train, val = noise.filter("k % 4 <> 0"), noise.filter("k % 4 = 0")
    spec = replace(models.boosted_raw(NAMES, maxIter=30, maxDepth=5, minInstancesPerNode=1, stepSize=1.0), patience=4)
    model = spec.fit(train, val)
    best = model.pipeline.stages[1].getNumTrees
    assert best + 4 <= 5 and grown == [5]
    long = replace(spec, patience=None).fit(train, val).pipeline.stages[1]
    assert [t.toDebugString.split("\n", 1)[1] for t in long.trees[:best]] == [t.toDebugString.split("\n", 1)[1] for t in model.pipeline.stages[1].trees]
    path = scratch_path(spark, "short")
    model.save(path)
    a, b = ([r.prediction for r in m.predict(val).orderBy("k").collect()] for m in (model, models.load_model(path)))
    assert a == b and {r.feature for r in model.importances(spark).collect()} == set(NAMES)
