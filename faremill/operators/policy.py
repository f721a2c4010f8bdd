"""Two-way fixed-effects difference-in-differences on the daily fact.

The dense matrix with one dummy per zone is never built. Rows are reduced to cells (zone,
period, weekday) holding counts and outcome moments; within-zone cross products follow from
the cells, and only the cross-product table of the few remaining regressors reaches the
driver for the solve.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_start, month_text
from ..functions.numeric import exact_sum, round_half_even
from ..schema import PolicySpec
from ..session import materialise

# Weekday labels; the first in text order is the reference level.
WEEKDAYS = ("Fri", "Mon", "Sat", "Sun", "Thu", "Tue", "Wed")
INTERACTION = "post_treated"
_CONST = "const"
_Y = "y"


def study_rows(daily: DataFrame, run_date: date, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Treated and control rows from the study start to the day before the run."""
    treated = (F.col("pickup_borough") == spec.treated_borough) & (F.col("service_zone") == spec.treated_service_zone)
    control = F.col("pickup_borough").isin(*spec.control_boroughs)
    in_time = (F.col(spec.day) >= F.lit(spec.start)) & (F.col(spec.day) < F.lit(run_date))
    post = (F.col(spec.day) >= F.lit(spec.effective)).cast("int")
    return (
        daily.filter(in_time & (treated | control))
        .withColumns({"treated": treated.cast("int"), "post": post})
        .withColumn(INTERACTION, F.col("post") * F.col("treated"))
    )


def arm_sizes(rows: DataFrame, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Zones per arm and the last observed day."""
    return rows.agg(
        F.count_distinct(F.when(F.col("treated") == 1, F.col(spec.key))).alias("n_treatment_zones"),
        F.count_distinct(F.when(F.col("treated") == 0, F.col(spec.key))).alias("n_control_zones"),
        F.max(spec.day).alias("post_end"),
    )


def zone_periods(rows: DataFrame, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Average outcome per zone before and after the policy date."""
    n = F.count(F.lit(1))
    return rows.groupBy(spec.key, "pickup_borough", "service_zone", "treated", "post").agg(
        round_half_even(F.sum("trip_count") / n, 2).alias("avg_trip_count"),
        round_half_even(exact_sum("total_revenue") / n, 2).alias("avg_revenue"),
        round_half_even(exact_sum("total_congestion_fees") / n, 4).alias("avg_congestion_fees"),
    ).select(
        spec.key, "pickup_borough", "service_zone", (F.col("treated") == 1).alias("treated"),
        F.when(F.col("post") == 1, F.lit("post")).otherwise(F.lit("pre")).alias("period"),
        "avg_trip_count", "avg_revenue", "avg_congestion_fees",
    )


def _entry(name: Column | str, value: Column) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    return F.struct(label.alias("name"), value.cast("double").alias("value"))


def _cells(rows: DataFrame, outcome: str, by: Sequence[str]) -> DataFrame:
    """Counts and outcome moments per cell; the only step that sees data-sized input."""
    y = F.col(outcome).cast("double")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.sum(y).alias("_sy"), F.sum(y * y).alias("_syy")
    )


def _weekday_entry(spec: PolicySpec) -> Column:
    return _entry(F.concat(F.lit("dow_"), F.col(spec.weekday)), (F.col(spec.weekday) != WEEKDAYS[0]).cast("int"))


def _effect_regressors(cells: DataFrame, spec: PolicySpec) -> DataFrame:
    x = F.array(
        _entry(_CONST, F.lit(1)), _entry("post", F.col("post")), _entry(INTERACTION, F.col("post") * F.col("treated")),
        _weekday_entry(spec),
    )
    return cells.withColumn("_x", F.filter(x, lambda e: e["value"] != 0))


def effect_cells(rows: DataFrame, outcome: str, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Cells of the pre/post design with their regressor values."""
    return _effect_regressors(_cells(rows, outcome, [spec.key, "treated", "post", spec.weekday]), spec)


def effect_cube(rows: DataFrame, outcomes: Sequence[str], spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Cells of the pre/post design with the moments of several outcomes, written once: one pass over the rows."""
    moments = []
    for o in outcomes:
        y = F.col(o).cast("double")
        moments += [F.sum(y).alias(f"_sy_{o}"), F.sum(y * y).alias(f"_syy_{o}")]
    cells = rows.groupBy(spec.key, "treated", "post", spec.weekday).agg(F.count(F.lit(1)).cast("double").alias("_n"), *moments)
    return materialise(cells, "policy-cube")


def cells_of(cube: DataFrame, outcome: str, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """The cells of one outcome, as :func:`effect_cells` has them."""
    own = cube.select(spec.key, "treated", "post", spec.weekday, "_n", F.col(f"_sy_{outcome}").alias("_sy"), F.col(f"_syy_{outcome}").alias("_syy"))
    return _effect_regressors(own, spec)


def event_cells(rows: DataFrame, outcome: str, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Cells of the month-by-month design; the last month before the policy is the reference."""
    reference = month_start(spec.effective, 1).strftime("%Y-%m")
    dated = rows.withColumn("_month", month_text(spec.day))
    cells = _cells(dated, outcome, [spec.key, "treated", "_month", spec.weekday])
    counted = (F.col("_month") != reference).cast("int")
    x = F.array(
        _entry(_CONST, F.lit(1)),
        _entry(F.concat(F.lit("month_"), F.col("_month")), counted),
        _entry(F.concat(F.lit("treated_"), F.col("_month")), counted * F.col("treated")),
        _weekday_entry(spec),
    )
    return cells.withColumn("_x", F.filter(x, lambda e: e["value"] != 0))


def cross_products(cells: DataFrame, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Cross-product table ``(row_name, col_name, total, within)`` of regressors and outcome.

    ``total`` is the plain sum of products, ``within`` the same after taking out zone means:
    sum of products minus, per zone, product of sums over n. Products are formed inside a
    cell between its few non-zero regressors, so their number follows the design's width.
    """
    return _summed(_zone_terms(cells, spec))


def _summed(terms: DataFrame, *by: str) -> DataFrame:
    return terms.groupBy(*by, F.col("i").alias("row_name"), F.col("j").alias("col_name")).agg(F.sum("total").alias("total"), F.sum("within").alias("within"))


def zone_products(cells: DataFrame, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """The cross-product table of each zone: (zone, row_name, col_name, total, within)."""
    return _summed(_zone_terms(cells, spec), spec.key)


def _zone_terms(cells: DataFrame, spec: PolicySpec) -> DataFrame:
    """(zone, i, j, total, within): plain products, and the zone's mean products to take out of ``within``."""
    pairs = F.flatten(
        F.transform(
            "_x",
            lambda a: F.transform(
                F.col("_x"),
                lambda b: F.struct(a["name"].alias("i"), b["name"].alias("j"), (a["value"] * b["value"] * F.col("_n")).alias("v")),
            ),
        )
    )
    with_y = F.transform("_x", lambda a: F.struct(a["name"].alias("i"), F.lit(_Y).alias("j"), (a["value"] * F.col("_sy")).alias("v")))
    y_only = F.array(F.struct(F.lit(_Y).alias("i"), F.lit(_Y).alias("j"), F.col("_syy").alias("v")))
    per_zone = (
        cells.select(spec.key, F.explode(F.concat(pairs, with_y, y_only)).alias("p"))
        .groupBy(spec.key, F.col("p.i").alias("i"), F.col("p.j").alias("j"))
        .agg(F.sum("p.v").alias("v"))
    )
    # One row per zone with its regressor sums; its length is the width of the design.
    sums = (
        per_zone.filter(F.col("i") == _CONST)
        .groupBy(spec.key)
        .agg(
            F.max(F.when(F.col("j") == _CONST, F.col("v"))).alias("n"),
            F.array_sort(F.collect_list(F.when(F.col("j") != _CONST, F.struct("j", "v")))).alias("s"),
        )
    )
    outer = F.flatten(
        F.transform(
            "s",
            lambda a: F.transform(
                F.col("s"),
                lambda b: F.struct(a["j"].alias("i"), b["j"].alias("j"), (-(a["v"] * b["v"]) / F.col("n")).alias("v")),
            ),
        )
    )
    means = sums.select(spec.key, F.explode(outer).alias("p")).filter((F.col("p.i") != _Y) | (F.col("p.j") == _Y))
    zero = F.lit(0.0)
    return per_zone.select(spec.key, "i", "j", F.col("v").alias("total"), F.col("v").alias("within")).unionByName(
        means.select(spec.key, F.col("p.i").alias("i"), F.col("p.j").alias("j"), zero.alias("total"), F.col("p.v").alias("within"))
    )


@dataclass(frozen=True)
class Fit:
    names: tuple[str, ...]
    beta: tuple[float, ...]
    p_value: tuple[float | None, ...]
    r_squared: float
    n_rows: int
    rank: int

    def effect(self, name: str = INTERACTION) -> tuple[float, float | None]:
        if name not in self.names:
            return 0.0, None
        i = self.names.index(name)
        return self.beta[i], self.p_value[i]


def solve(products: DataFrame, n_zones: int) -> Fit:
    """Least squares from the collected cross products (a few dozen names squared)."""
    table = {(r["row_name"], r["col_name"]): (r["total"], r["within"]) for r in products.collect()}
    names = tuple(sorted({i for i, _ in table} - {_CONST, _Y}))
    a = np.array([[table.get((i, j), (0.0, 0.0))[1] for j in names] for i in names]).reshape(len(names), len(names))
    c = np.array([table.get((i, _Y), (0.0, 0.0))[1] for i in names])
    n, sum_y, sum_yy = table[(_CONST, _CONST)][0], table[(_CONST, _Y)][0], table[(_Y, _Y)][0]
    within_yy = table[(_Y, _Y)][1]
    rank = int(np.linalg.matrix_rank(a, hermitian=True)) if names else 0
    inverse = np.linalg.pinv(a, hermitian=True) if names else a
    beta = inverse @ c
    ssr = max(float(within_yy - beta @ c), 0.0)
    sst = sum_yy - sum_y * sum_y / n
    dof = int(n) - n_zones - rank
    p_values: list[float | None] = []
    for k in range(len(names)):
        variance = ssr / dof * inverse[k, k] if dof > 0 else 0.0
        if variance > 0:
            p_values.append(student_t_two_sided(float(beta[k]) / math.sqrt(variance), dof))
        else:
            p_values.append(None)
    r2 = 1.0 - ssr / sst if sst > 0 else math.nan
    return Fit(names, tuple(float(b) for b in beta), tuple(p_values), r2, int(n), rank)


def score_products(zones: DataFrame, beta: dict[str, float], spec: PolicySpec = PolicySpec()) -> DataFrame:
    """(row_name, col_name, product): sums over zones of the outer products of each zone's scores.

    A zone's score of a regressor is the sum of its (within-zone) values times the residuals at ``beta``; names that
    ``beta`` lacks count as 0. A zone is one row as wide as the design, so nothing but its few names is paired.
    """
    weight = F.when(F.col("col_name") == _Y, F.lit(1.0))
    for name, b in beta.items():
        weight = weight.when(F.col("col_name") == name, F.lit(-float(b)))
    named = zones.where((F.col("row_name") != _CONST) & (F.col("row_name") != _Y) & (F.col("col_name") != _CONST))
    scores = named.groupBy(spec.key, "row_name").agg(F.coalesce(F.sum(F.col("within") * weight), F.lit(0.0)).alias("score"))
    wide = scores.groupBy(spec.key).agg(F.collect_list(F.struct("row_name", "score")).alias("s"))
    pairs = F.flatten(F.transform("s", lambda a: F.transform(F.col("s"), lambda b: F.struct(a["row_name"].alias("row_name"), b["row_name"].alias("col_name"), (a["score"] * b["score"]).alias("v")))))
    return wide.select(F.explode(pairs).alias("p")).groupBy("p.row_name", "p.col_name").agg(F.sum("p.v").alias("product"))


@dataclass(frozen=True)
class ClusteredFit:
    fit: Fit
    std_error: tuple[float, ...]
    p_value: tuple[float | None, ...]


def clustered_fit(cells: DataFrame, n_zones: int, spec: PolicySpec = PolicySpec()) -> ClusteredFit:
    """The fit with a covariance that allows any correlation of a zone's days.

    The sandwich of the inverse cross products around the zones' score products, times
    zones / (zones - 1) * (rows - 1) / (rows - rank): the zone effects lie within zones and cost no degree of
    freedom there. Tails are Student's with zones - 1 degrees. The zones' products are written once and read for both parts.
    """
    zones = materialise(zone_products(cells, spec), "zone-products")
    products = materialise(zones.groupBy("row_name", "col_name").agg(F.sum("total").alias("total"), F.sum("within").alias("within")), "products")
    fit = solve(products, n_zones)
    k, names = len(fit.names), {n: i for i, n in enumerate(fit.names)}
    a, meat = np.zeros((k, k)), np.zeros((k, k))
    for r in products.collect():
        if r["row_name"] in names and r["col_name"] in names:
            a[names[r["row_name"]], names[r["col_name"]]] = r["within"]
    for r in score_products(zones, dict(zip(fit.names, fit.beta, strict=True)), spec).collect():
        meat[names[r["row_name"]], names[r["col_name"]]] = r["product"]
    inverse = np.linalg.pinv(a, hermitian=True) if k else a
    scale = n_zones / (n_zones - 1) * (fit.n_rows - 1) / (fit.n_rows - fit.rank) if n_zones > 1 else math.nan
    errors = np.sqrt(np.maximum(np.diag(inverse @ meat @ inverse) * scale, 0.0))
    p = [student_t_two_sided(b / e, n_zones - 1) if e > 0 else None for b, e in zip(fit.beta, errors.tolist(), strict=True)]
    return ClusteredFit(fit, tuple(errors.tolist()), tuple(p))


def student_t_two_sided(t: float, dof: float) -> float:
    """Two-sided tail of Student's t through the regularised incomplete beta function."""
    return _incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    # Continued fraction evaluated from the front with running numerators and denominators.
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d or 1e-300)
    value = d
    # The number of steps needed grows with the square root of the larger parameter.
    for m in range(1, 1000 + 10 * math.isqrt(math.ceil(max(a, b)))):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for coefficient in (even, odd):
            d = 1.0 / ((1.0 + coefficient * d) or 1e-300)
            c = (1.0 + coefficient / c) or 1e-300
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            return front * value
    raise ArithmeticError(f"no convergence at a={a}, b={b}, x={x}")


def fit_effect(rows: DataFrame, outcome: str, n_zones: int, spec: PolicySpec = PolicySpec()) -> Fit:
    return solve(cross_products(effect_cells(rows, outcome, spec), spec), n_zones)


def fit_event_study(rows: DataFrame, outcome: str, n_zones: int, spec: PolicySpec = PolicySpec()) -> Fit:
    return solve(cross_products(event_cells(rows, outcome, spec), spec), n_zones)


def zone_count(rows: DataFrame, spec: PolicySpec = PolicySpec()) -> int:
    return rows.agg(F.count_distinct(spec.key)).first()[0]


def without_control(spec: PolicySpec, borough: str) -> PolicySpec:
    return replace(spec, control_boroughs=tuple(b for b in spec.control_boroughs if b != borough))


def impact_table(daily: DataFrame, run_date: date, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """Zone-period averages with the run's coefficients attached to every row."""
    rows = study_rows(daily, run_date, spec)
    cube = effect_cube(rows, ("trip_count", "total_revenue"), spec)
    n_zones = zone_count(cube, spec)
    if n_zones == 0:
        raise ValueError(f"no daily rows before {run_date}")
    trips, revenue = (solve(cross_products(cells_of(cube, o, spec), spec), n_zones) for o in ("trip_count", "total_revenue"))
    (b_trips, p_trips), (b_revenue, p_revenue) = trips.effect(), revenue.effect()
    constants = {
        "did_trip_count": b_trips,
        "did_revenue": b_revenue,
        "p_value_trip_count": p_trips,
        "p_value_revenue": p_revenue,
        "r2_trip_count": trips.r_squared,
        "r2_revenue": revenue.r_squared,
    }
    attached = zone_periods(rows, spec).withColumns({k: F.lit(v).cast("double") for k, v in constants.items()})
    return attached.withColumn("_run_date", F.lit(run_date))


def beta_series(impact: DataFrame) -> DataFrame:
    """One row per run with its coefficients."""
    return impact.select(
        F.col("_run_date").alias("run_date"), F.col("did_trip_count").alias("beta_trip_count"),
        F.col("did_revenue").alias("beta_revenue"), "p_value_trip_count", "p_value_revenue", "r2_trip_count", "r2_revenue",
    ).distinct()


def borough_summary(impact: DataFrame) -> DataFrame:
    """Borough by period and run: summed averages, mean coefficients."""
    return impact.groupBy(
        F.col("pickup_borough").alias("borough"), "period", F.col("treated").alias("is_treated"), F.col("_run_date").alias("run_date")
    ).agg(
        exact_sum("avg_trip_count").alias("total_avg_daily_trips"),
        exact_sum("avg_revenue").alias("total_avg_daily_revenue"),
        F.avg("did_trip_count").alias("did_beta_trip_count"),
        F.avg("p_value_trip_count").alias("did_p_value"),
    )


def latest_run(df: DataFrame, run: str = "run_date") -> DataFrame:
    """Rows of the newest run; the maximum is a scalar subquery."""
    return df.filter(F.col(run) == df.agg(F.max(run)).scalar())


def borough_change(summary: DataFrame) -> DataFrame:
    """Absolute and percentage change from the pre to the post period per borough."""
    wide = summary.groupBy("run_date", "borough", "is_treated").pivot("period", ["pre", "post"]).agg(
        F.max("total_avg_daily_trips").alias("trips"), F.max("total_avg_daily_revenue").alias("revenue")
    )
    out = ["run_date", "borough", "is_treated"]
    for m in ("trips", "revenue"):
        change = F.col(f"post_{m}") - F.col(f"pre_{m}")
        out += [
            F.col(f"pre_{m}"), F.col(f"post_{m}"), change.alias(f"{m}_change"),
            (F.try_divide(change, F.col(f"pre_{m}")) * 100).alias(f"{m}_change_pct"),
        ]
    return wide.select(*out)
