"""Queries of the policy study."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import marts, policy, synthetic
from ..schema import PolicySpec
from ..session import materialise, scratch_path
from ..sources import tables
from . import oracle
from .catalog import DT, daily_of, register, rounded
from .oracle import block, half_up, total

RUN_DATE = date(2025, 8, 5)
RUNS = (date(2025, 4, 5), date(2025, 6, 5), RUN_DATE)
SPEC = PolicySpec()

block(
    "study",
    """SELECT *, CAST(pickup_borough = 'Manhattan' AND service_zone = 'Yellow Zone' AS INT) AS treated,
    CAST(pickup_date >= DATE '2025-01-05' AS INT) AS post,
    CAST(pickup_date >= DATE '2025-01-05' AND pickup_borough = 'Manhattan' AND service_zone = 'Yellow Zone' AS INT) AS post_treated
  FROM daily WHERE pickup_date >= DATE '2024-01-01' AND pickup_date < DATE '2025-08-05'
    AND ((pickup_borough = 'Manhattan' AND service_zone = 'Yellow Zone') OR pickup_borough IN ('Brooklyn', 'Queens', 'Bronx'))""",
    "daily",
)


def _daily(spark, sf_dir):
    return materialise(daily_of(spark, sf_dir), "daily")


@register("study_groups", oracle.sql(
    "SELECT CAST(treated AS BIGINT) AS treated, CAST(post AS BIGINT) AS post, CAST(post_treated AS BIGINT) AS post_treated,"
    " count(*) AS zone_days, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM study GROUP BY 1, 2, 3", "study"))
def _groups(spark, sf_dir):
    """Treatment and control assignment."""
    return policy.study_rows(daily_of(spark, sf_dir), RUN_DATE).groupBy("treated", "post", "post_treated").agg(
        F.count(F.lit(1)).alias("zone_days"), F.sum("trip_count").alias("trip_count"))


@register("arm_sizes", oracle.sql(
    "SELECT count(DISTINCT CASE WHEN treated = 1 THEN pu_location_id END) AS n_treatment_zones,"
    " count(DISTINCT CASE WHEN treated = 0 THEN pu_location_id END) AS n_control_zones,"
    " strftime(max(pickup_date), '%Y-%m-%d') AS post_end FROM study", "study"))
def _arms(spark, sf_dir):
    return policy.arm_sizes(policy.study_rows(daily_of(spark, sf_dir), RUN_DATE))


def _even(x: str, digits: int) -> str:
    s = f"{10**digits}E0"
    return f"round_even({x}*{s}, 0)/{s}"


block(
    "zone_periods",
    f"""SELECT pu_location_id, pickup_borough, service_zone, treated = 1 AS treated, CASE WHEN post = 1 THEN 'post' ELSE 'pre' END AS period,
    {_even("CAST(sum(trip_count) AS DOUBLE)/count(*)", 2)} AS avg_trip_count, {_even(total("total_revenue") + "/count(*)", 2)} AS avg_revenue,
    {_even(total("total_congestion_fees") + "/count(*)", 4)} AS avg_congestion_fees
  FROM study GROUP BY pu_location_id, pickup_borough, service_zone, treated, post""",
    "study",
)


@register("zone_periods", oracle.sql(
    "SELECT * REPLACE (CAST(pu_location_id AS BIGINT) AS pu_location_id) FROM zone_periods", "zone_periods"))
def _zone_periods(spark, sf_dir):
    """Average outcome per zone before and after the policy date."""
    return policy.zone_periods(policy.study_rows(daily_of(spark, sf_dir), RUN_DATE))


_X = ("post", "post_treated", "dow_Mon", "dow_Sat", "dow_Sun", "dow_Thu", "dow_Tue", "dow_Wed")


def _products_sql() -> str:
    columns = {c: c for c in ("post", "post_treated")} | {c: f"CAST(day_of_week = '{c[4:]}' AS INT)" for c in _X[2:]} | {"y": "trip_count"}
    design = ", d AS (SELECT pu_location_id, " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in columns.items()) + " FROM study)"
    zone = ", z AS (SELECT pu_location_id, count(*) AS n, " + ", ".join(f"sum({c}) AS s_{c}" for c in columns)
    pairs = [(a, b) for a in columns for b in columns if a != "y" or b == "y"]
    zone += ", " + ", ".join(f"sum({a}*{b}) AS p_{a}__{b}" for a, b in pairs) + " FROM d GROUP BY 1)"
    # Pairs that never occur together and have no zone mean product do not exist on either side.
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS col_name, sum(p_{a}__{b}) AS total, sum(p_{a}__{b} - s_{a}*s_{b}/n) AS within FROM z" for a, b in pairs
    )
    return f"{design}{zone} SELECT row_name, col_name, total, {half_up('within', 6)} AS within FROM ({rows})"


@register("did_cross_products", oracle.sql(_products_sql(), "study"))
def _products(spark, sf_dir):
    """Cross products of the fixed-effects regression, plain and within zones."""
    cells = policy.effect_cells(policy.study_rows(daily_of(spark, sf_dir), RUN_DATE), "trip_count")
    table = policy.cross_products(cells)
    return rounded(table.filter((F.col("row_name") != "const") & (F.col("col_name") != "const")), ["within"])


def _coefficients(spark, fits):
    rows = [
        (label, name, fit.beta[i], fit.p_value[i], fit.r_squared, fit.n_rows)
        for label, fit in fits
        for i, name in enumerate(fit.names)
        if not name.startswith("dow_")
    ]
    return spark.createDataFrame(rows, "run string, term string, beta double, p_value double, r_squared double, n_rows bigint")


@register("did_fit")
def _fit(spark, sf_dir):
    """Two-way fixed-effects estimate for both outcomes."""
    outcomes = ("trip_count", "total_revenue")
    cube = policy.effect_cube(policy.study_rows(daily_of(spark, sf_dir), RUN_DATE), outcomes)
    n = policy.zone_count(cube)
    return _coefficients(spark, [(o, policy.solve(policy.cross_products(policy.cells_of(cube, o)), n)) for o in outcomes])


def _scores_sql() -> str:
    z = _products_sql()
    z = z[: z.index(" SELECT row_name")]
    score = {a: f"(p_{a}__y - s_{a}*s_y/n)" for a in _X}
    rows = " UNION ALL ".join(f"SELECT '{a}' AS row_name, '{b}' AS col_name, sum({score[a]}*{score[b]}) AS product FROM z" for a in _X for b in _X)
    return f"{z} SELECT row_name, col_name, round(product / 1E3) AS product FROM ({rows})"


@register("did_score_products", oracle.sql(_scores_sql(), "study"))
def _score_products(spark, sf_dir):
    """Score products of zones where no regressor has an effect: the meat of the clustered covariance at zero."""
    cells = policy.effect_cells(policy.study_rows(daily_of(spark, sf_dir), RUN_DATE), "trip_count")
    products = policy.score_products(policy.zone_products(cells), {})
    return products.select("row_name", "col_name", F.round(F.col("product") / 1e3).alias("product"))


@register("did_clustered")
def _clustered(spark, sf_dir):
    """The two-way fit with errors clustered by zone."""
    rows = policy.study_rows(_daily(spark, sf_dir), RUN_DATE)
    found = policy.clustered_fit(policy.effect_cells(rows, "trip_count"), policy.zone_count(rows))
    out = [(n, found.fit.beta[i], found.std_error[i], found.p_value[i], found.fit.p_value[i]) for i, n in enumerate(found.fit.names)]
    return spark.createDataFrame(out, "term string, beta double, clustered_error double, clustered_p_value double, plain_p_value double")


_WEEKS = (
    ", w AS (SELECT pu_location_id, treated, CAST(date_trunc('week', pickup_date) AS DATE) AS week, CAST(sum(trip_count) AS DOUBLE) AS value FROM study"
    " WHERE date_trunc('week', pickup_date) <> DATE '2024-12-30' GROUP BY ALL),"
    " whole AS (SELECT pu_location_id FROM w GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT week) FROM w)),"
    " series AS (SELECT * FROM w WHERE pu_location_id IN (SELECT pu_location_id FROM whole))"
)


@register("synthetic_gap", oracle.sql(
    f"{_WEEKS}, given AS (SELECT pu_location_id, (pu_location_id % 3 + 1) * 1.0E0 / (SELECT sum(pu_location_id % 3 + 1) FROM (SELECT DISTINCT pu_location_id FROM series WHERE treated = 0)) AS weight"
    " FROM (SELECT DISTINCT pu_location_id FROM series WHERE treated = 0))"
    " SELECT strftime(week, '%Y-%m-%d') AS week, week >= DATE '2025-01-05' AS post, " + half_up("treated", 4) + " AS treated, " + half_up("synthetic", 4) + " AS synthetic, " + half_up("treated - synthetic", 4) + " AS gap"
    " FROM (SELECT week, sum(CASE WHEN treated = 1 THEN value END) / count(CASE WHEN treated = 1 THEN 1 END) AS treated, sum(CASE WHEN treated = 0 THEN value * weight END) AS synthetic"
    " FROM series LEFT JOIN given USING (pu_location_id) GROUP BY week)", "study"))
def _synthetic_gap(spark, sf_dir):
    """Weekly gap between the treated zones and a mix of the others with given weights."""
    series = synthetic.weekly_series(policy.study_rows(_daily(spark, sf_dir), RUN_DATE), "trip_count")
    donors = series.where("treated = 0").select("pu_location_id").distinct().withColumn("share", (F.col("pu_location_id") % 3 + 1).cast("double"))
    weights = donors.select("pu_location_id", (F.col("share") / donors.agg(F.sum("share")).scalar()).alias("weight"))
    return rounded(synthetic.gap_series(series, weights), ["treated", "synthetic", "gap"], 4)


@register("synthetic_weights", oracle.sql(
    f"{_WEEKS} SELECT count(DISTINCT pu_location_id) AS donors, 1.0E0 AS total, true AS none_negative, true AS nearer_than_equal_weights FROM series WHERE treated = 0", "study"))
def _synthetic_weights(spark, sf_dir):
    """Fitted weights: what they must be, and that they follow the treated series better than equal ones."""
    series = materialise(synthetic.weekly_series(policy.study_rows(_daily(spark, sf_dir), RUN_DATE), "trip_count"), "weekly")
    weights = synthetic.donor_weights(series)
    equal = weights.withColumn("weight", 1 / weights.agg(F.count(F.lit(1))).scalar())
    error = lambda w: synthetic.gap_series(series, w).where("not post").agg(F.sum(F.col("gap") * F.col("gap"))).scalar()
    return weights.agg(
        F.count(F.lit(1)).alias("donors"), F.round(F.sum("weight"), 9).alias("total"), (F.min("weight") >= 0).alias("none_negative"), F.first(error(weights) <= error(equal)).alias("nearer_than_equal_weights"))


@register("did_robustness")
def _robustness(spark, sf_dir):
    """Placebo date a year earlier on pre-policy rows, and the fit without one control borough."""
    from dataclasses import replace

    daily = _daily(spark, sf_dir)
    placebo = replace(SPEC, effective=date(2024, 7, 5))
    fits = []
    for label, spec, until in (("placebo", placebo, SPEC.effective), ("without_queens", policy.without_control(SPEC, "Queens"), RUN_DATE)):
        rows = policy.study_rows(daily, until, spec)
        fits.append((label, policy.fit_effect(rows, "trip_count", policy.zone_count(rows, spec), spec)))
    return _coefficients(spark, fits)


@register("did_event_study")
def _event_study(spark, sf_dir):
    """Effect per month against the last month before the policy."""
    rows = policy.study_rows(_daily(spark, sf_dir), RUN_DATE)
    fit = policy.fit_event_study(rows, "trip_count", policy.zone_count(rows))
    return _coefficients(spark, [("event_study", fit)]).filter(F.col("term").startswith("treated_"))


def _impact(spark, sf_dir):
    """Impact table after three monthly runs, the last one repeated."""
    from .policy import run_policy_study

    daily = _daily(spark, sf_dir)
    path = scratch_path(spark, "impact")
    for run in (*RUNS, RUNS[-1]):
        run_policy_study(spark, daily, run, path)
    return tables.read_table(spark, path, None).drop("run_key")


@register("impact_rows")
def _impact_rows(spark, sf_dir):
    return _impact(spark, sf_dir)


@register("beta_series")
def _betas(spark, sf_dir):
    return policy.beta_series(_impact(spark, sf_dir))


@register("model_fit_table")
def _fit_table(spark, sf_dir):
    return marts.model_fit_table(policy.beta_series(_impact(spark, sf_dir)))


@register("latest_betas")
def _latest_betas(spark, sf_dir):
    """Coefficients of the newest run."""
    return policy.latest_run(policy.beta_series(_impact(spark, sf_dir)))


def _runs_sql() -> str:
    """Zone-period averages for each of the three runs."""
    per_run = " UNION ALL ".join(
        f"SELECT DATE '{run}' AS run_date, pu_location_id, pickup_borough, treated = 1 AS treated, CASE WHEN post = 1 THEN 'post' ELSE 'pre' END AS period,"
        f" {_even('CAST(sum(trip_count) AS DOUBLE)/count(*)', 2)} AS avg_trip_count, {_even(total('total_revenue') + '/count(*)', 2)} AS avg_revenue"
        f" FROM study WHERE pickup_date < DATE '{run}' GROUP BY pu_location_id, pickup_borough, treated, post"
        for run in RUNS
    )
    return (
        f", runs AS ({per_run}), summary AS (SELECT pickup_borough AS borough, period, treated AS is_treated, run_date,"
        f" {total('avg_trip_count')} AS total_avg_daily_trips, {total('avg_revenue')} AS total_avg_daily_revenue FROM runs GROUP BY 1, 2, 3, 4) "
    )


@register("borough_summary", oracle.sql(
    _runs_sql() + "SELECT * REPLACE (strftime(run_date, '%Y-%m-%d') AS run_date) FROM summary", "study"))
def _summary(spark, sf_dir):
    """Summed zone averages per borough, period and run (coefficients left out of the comparison)."""
    return policy.borough_summary(_impact(spark, sf_dir)).drop("did_beta_trip_count", "did_p_value")


@register("borough_coefficients", oracle.sql(
    _runs_sql() + "SELECT borough, period, is_treated, strftime(run_date, '%Y-%m-%d') AS run_date, total_avg_daily_trips,"
    " month(run_date) * 0.25E0 AS did_beta_trip_count, 1.0E0 / month(run_date) AS did_p_value FROM summary", "study"))
def _summary_coefficients(spark, sf_dir):
    """The borough summary with its coefficients, of runs whose coefficients are given."""
    daily = _daily(spark, sf_dir)
    runs = None
    for run in RUNS:
        given = {"did_trip_count": run.month * 0.25, "did_revenue": 0.0, "p_value_trip_count": 1 / run.month, "p_value_revenue": 0.0, "r2_trip_count": 1.0, "r2_revenue": 1.0}
        rows = policy.zone_periods(policy.study_rows(daily, run)).withColumns({k: F.lit(v) for k, v in given.items()}).withColumn("_run_date", F.lit(run))
        runs = rows if runs is None else runs.unionByName(rows)
    return policy.borough_summary(runs).drop("total_avg_daily_revenue")


@register("latest_pre_post", oracle.sql(
    _runs_sql() + "SELECT strftime(run_date, '%Y-%m-%d') AS run_date, borough, max(total_avg_daily_trips) FILTER (WHERE period = 'pre') AS pre,"
    " max(total_avg_daily_trips) FILTER (WHERE period = 'post') AS post FROM summary WHERE run_date = (SELECT max(run_date) FROM summary) GROUP BY summary.run_date, borough", "study"))
def _pre_post(spark, sf_dir):
    """Newest run's pre and post trips per borough."""
    return marts.latest_pre_post(policy.borough_summary(_impact(spark, sf_dir)))


@register("borough_change", oracle.sql(
    _runs_sql() + ", w AS (SELECT run_date, borough, is_treated, " + ", ".join(
        f"max({c}) FILTER (WHERE period = '{p}') AS {p}_{m}" for m, c in (("trips", "total_avg_daily_trips"), ("revenue", "total_avg_daily_revenue")) for p in ("pre", "post"))
    + " FROM summary GROUP BY 1, 2, 3) SELECT strftime(run_date, '%Y-%m-%d') AS run_date, borough, is_treated, " + ", ".join(
        f"pre_{m}, post_{m}, {half_up(f'post_{m} - pre_{m}', 6)} AS {m}_change, {half_up(f'(post_{m} - pre_{m})/pre_{m}*100', 6)} AS {m}_change_pct" for m in ("trips", "revenue"))
    + " FROM w", "study"))
def _change(spark, sf_dir):
    """Raw change from the pre to the post period."""
    changes = policy.borough_change(policy.borough_summary(_impact(spark, sf_dir)))
    return rounded(changes, ["trips_change", "trips_change_pct", "revenue_change", "revenue_change_pct"])
