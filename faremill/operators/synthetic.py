"""Synthetic control: a weighted mix of untreated zones that follows the treated ones before a policy.

Data-sized work is one aggregation to zone by week. The weights are the least-squares mix over the weeks before the
policy, none negative, summing to one; they are solved on the driver from a table as large as the zones times those
weeks. The gap after the policy between the treated series and the mix is the effect.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PolicySpec

STEPS, TOLERANCE = 20_000, 1e-12


def weekly_series(rows: DataFrame, outcome: str, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """(zone, treated, week, value): the outcome per zone and week, weeks named by their Monday.

    Only weeks that lie wholly before or wholly after the policy date count, and only zones with rows in each of them.
    """
    week = F.date_trunc("week", F.col(spec.day)).cast("date")
    split = F.date_trunc("week", F.lit(spec.effective)).cast("date")
    kept = rows.withColumn("week", week).where((F.lit(spec.effective) == split) | (F.col("week") != split))
    series = kept.groupBy(spec.key, "treated", "week").agg(F.sum(F.col(outcome).cast("double")).alias("value"))
    weeks = series.agg(F.count_distinct("week").alias("n")).scalar()
    whole = series.groupBy(spec.key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == weeks).select(spec.key)
    return series.join(whole, spec.key, "left_semi")


def on_simplex(x: np.ndarray) -> np.ndarray:
    """The nearest point whose parts are not negative and sum to one."""
    down = np.sort(x)[::-1]
    excess = (np.cumsum(down) - 1) / np.arange(1, len(x) + 1)
    return np.maximum(x - excess[np.flatnonzero(down > excess)[-1]], 0)


def simplex_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weights w >= 0 of sum one with the least |a w - b|, by accelerated projected gradients."""
    gram, moment = a.T @ a, a.T @ b
    step = 1 / max(float(np.linalg.eigvalsh(gram)[-1]), 1e-300)
    w = ahead = np.full(a.shape[1], 1 / a.shape[1])
    speed = 1.0
    for _ in range(STEPS):
        after = on_simplex(ahead - step * (gram @ ahead - moment))
        if float((after - w) @ (ahead - after)) > 0:
            # Momentum that leads back up starts anew.
            speed, ahead = 1.0, w
            after = on_simplex(w - step * (gram @ w - moment))
        following = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        ahead = after + (speed - 1) / following * (after - w)
        moved, w, speed = float(np.abs(after - w).max()), after, following
        if moved < TOLERANCE:
            break
    return w


def donor_weights(series: DataFrame, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """(zone, weight) of the untreated zones, from the weeks before the policy."""
    before = series.where(F.col("week") < F.lit(spec.effective))
    arms = before.groupBy("week").agg((F.sum(F.when(F.col("treated") == 1, F.col("value"))) / F.count_if(F.col("treated") == 1)).alias("target"))
    target = {r["week"]: r["target"] for r in arms.collect() if r["target"] is not None}
    donors = before.where(F.col("treated") == 0).groupBy(spec.key).agg(F.map_from_entries(F.collect_list(F.struct("week", "value"))).alias("by_week"))
    rows = sorted((r[spec.key], r["by_week"]) for r in donors.collect())
    if not rows or not target:
        raise ValueError("no treated or no untreated zone has a whole series before the policy")
    weeks = sorted(target)
    a, b = np.array([[by_week[w] for _, by_week in rows] for w in weeks]), np.array([target[w] for w in weeks])
    scale = max(float(np.abs(a).max()), 1e-300)
    weights = simplex_least_squares(a / scale, b / scale)
    kind = dict(series.dtypes)[spec.key]
    return series.sparkSession.createDataFrame([(k, float(w)) for (k, _), w in zip(rows, weights, strict=True)], f"{spec.key} {kind}, weight double")


def gap_series(series: DataFrame, weights: DataFrame, spec: PolicySpec = PolicySpec()) -> DataFrame:
    """(week, post, treated, synthetic, gap): mean of the treated zones, the weighted mix, and their difference."""
    treated = F.col("treated") == 1
    mixed = series.join(weights, spec.key, "left")
    out = mixed.groupBy("week").agg(
        (F.sum(F.when(treated, F.col("value"))) / F.count_if(treated)).alias("treated"),
        F.sum(F.when(~treated, F.col("value") * F.coalesce("weight", F.lit(0.0)))).alias("synthetic"),
    )
    return out.select("week", (F.col("week") >= F.lit(spec.effective)).alias("post"), "treated", "synthetic", (F.col("treated") - F.col("synthetic")).alias("gap"))
