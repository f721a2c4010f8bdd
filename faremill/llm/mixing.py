"""Mixing sources to target weights with DataFrame operations only.

Documents get a hash-random key. Key ranges cut each source into cells of about equal size; word counts
are summed per cell, prefix sums run over cells (two bounded levels) and then inside each cell, so neither
a hot source nor its prefix sum ever sits in one task. A source is taken in whole epochs and, for what is
left of its budget, in key order up to the exact word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(id_col: str) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":mix")))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(src, missing, source_size) -> the same with target.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of all sizes. A target
    stops at ``most`` times its source's size and the excess goes to the others by weight. Ordered by
    size / weight, the sources that stop are a prefix; the first one that doesn't fixes the share of a weight.
    The table has a row a source and is ranked as one partition.
    """
    by_name, by_ratio = Window.orderBy("missing", "src"), Window.orderBy(F.col("source_size") / F.col("weight"), "missing", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")).cast("long"))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))
    share = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    ranked = weighed.withColumn("share", share).withColumn("stops", F.col("source_size") * most < F.col("weight") * F.col("share"))
    ranked = ranked.withColumn("rank", F.row_number().over(by_ratio))
    level = F.min(F.when(~F.col("stops"), F.struct("rank", "share"))).over(everything)["share"]
    return ranked.withColumn("level", level).select(
        "src", "missing", "source_size", F.when(F.col("stops"), (F.col("source_size") * most).cast("double")).otherwise(F.col("weight") * F.col("level")).alias("target")
    )


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = (), weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Per document: id, size (words; 0 for null), source_size, target of its source, taken words; and ``carry``.

    taken counts repeats: whole epochs of the source times the size, and in key order the rest of the budget,
    cut inside a document if need be. The budget is the target rounded to a word, so a source's taken words
    differ from its target by half a word at most. Rows of a repeated id are separate documents. Reruns agree.
    An empty table gives an empty result; a source without words takes none.
    """
    named = docs.select(
        F.col(id_col).alias("id"),
        word_count(F.col(text_col)).alias("size"),
        F.coalesce(F.col(source_col), F.lit("")).alias("src"),
        F.col(source_col).isNull().alias("missing"),
        F.substring(_key(id_col), 1, 1).alias("range"),
        F.substring(_key(id_col), 1, 3).alias("cell"),
        *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)],
    )
    sizes = materialise(named.select("id", "size", "src", "missing", "range", "cell"), "sizes")
    source = ["src", "missing"]
    cells = materialise(sizes.groupBy(*source, "range", "cell").agg(F.sum("size").alias("words")), "cells")
    ranges = cells.groupBy(*source, "range").agg(F.sum("words").alias("words"))
    totals = cells.groupBy(*source).agg(F.sum("words").alias("source_size"))
    earlier = lambda keys, order: F.coalesce(F.sum("words").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(*source, "range", earlier(source, "range").alias("range_start")).join(targets(totals, weights, most), source)
    starts = cells.withColumn("inner_start", earlier([*source, "range"], "cell")).join(ranges, [*source, "range"])
    starts = starts.select(*source, "cell", (F.col("range_start") + F.col("inner_start")).alias("cell_start"), "source_size", "target")
    rows = (named if carry else sizes).join(starts, [*source, "cell"])
    in_cell = Window.partitionBy(*source, "cell").orderBy(_key("id"), "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("cell_start") + F.coalesce(F.sum("size").over(in_cell), F.lit(0))
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size")
    taken = whole * F.col("size") + F.least(F.greatest(rest - start, F.lit(0)), F.col("size"))
    return rows.select(
        F.col("id").alias(id_col), "size", "source_size", "target", taken.cast("long").alias("taken"), *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)]
    )
