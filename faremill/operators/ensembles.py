"""Combining several prediction columns of one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip_at_zero
from .models import FittedModel, ridge
from .windows import global_row_index


def weighted_blend(preds: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """Weighted sum of predictions, equal weights by default; not clipped."""
    weights = list(weights) if weights is not None else [1.0 / len(preds)] * len(preds)
    if len(weights) != len(preds):
        raise ValueError("one weight per prediction column is needed")
    return reduce(lambda a, b: a + b, [F.col(p) * F.lit(w) for p, w in zip(preds, weights)])


def rank_average(df: DataFrame, preds: Sequence[str], keys: Sequence[str], name: str = "prediction") -> DataFrame:
    """Average rank over the models, mapped back to the sorted mean predictions.

    ``keys`` identify a row and settle ties. All predictions and their mean become long rows (list,
    value, keys), so that one distributed sort and one write give every rank: each list has as many rows
    as the table, hence a list's ranks start at its number times that size. Only the rows of the first
    list carry the other columns. The average rank points at a position in the list of means; both
    meet in an equi-join on the position.
    """
    mean = reduce(lambda a, b: a + b, [F.col(p) for p in preds]) / len(preds)
    means = len(preds)
    rest = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    lists = [
        F.struct(F.lit(i).alias("_list"), v.cast("double").alias("_value"), (rest if i == 0 else F.lit(None)).alias("_rest"))
        for i, v in enumerate([*[F.col(p) for p in preds], mean])
    ]
    long = df.select(*keys, F.inline(F.array(*lists)))
    placed = global_row_index(long, [F.col("_list").asc(), F.col("_value").asc(), *[F.col(k).asc() for k in keys]], "_index")
    total = placed.where(F.col("_list") == means).agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    rank = F.col("_index") - F.col("_list") * total
    scale = placed.where(F.col("_list") == means).select(rank.alias("_position"), F.col("_value").alias("_mean"))
    rows = placed.where(F.col("_list") < means).withColumn("_rank", rank)
    ranked = rows.groupBy(*keys).agg(
        F.first("_rest", ignorenulls=True).alias("_rest"),
        *[F.max(F.when(F.col("_list") == i, F.col("_rank"))).alias(f"_rank_{i}") for i in range(means)],
    )
    span = F.greatest(total - 1, F.lit(1))
    share = reduce(lambda a, b: a + b, [F.col(f"_rank_{i}") / span for i in range(means)]) / len(preds)
    target = F.least(F.greatest(F.rint(share * (total - 1)), F.lit(0)), total - 1).cast("bigint")
    joined = ranked.withColumn("_position", target).join(scale, "_position", "left").withColumn("_result", clip_at_zero("_mean"))
    columns = [F.col(c) if c in keys else F.col(f"_rest.`{c}`") for c in df.columns if c != name]
    return joined.select(*columns, F.col("_result").alias(name))


def stack(val: DataFrame, preds: Sequence[str], alpha: float = 1.0) -> FittedModel:
    """Ridge on the base predictions of the validation rows, without standardisation."""
    return ridge(alpha, preds, standardise=False).fit(val)
