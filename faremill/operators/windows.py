"""Windows over long series and whole tables that stay spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import materialise

CHUNK = "_chunk"
OWN = "_own"
POSITION = "_position"


def series_positions(df: DataFrame, keys: Sequence[str], time: str, bucket: str = "month") -> DataFrame:
    """Add the 0-based row position within each key's time order.

    The series is numbered in time buckets: bucket sizes come from a small aggregate,
    their running total is each bucket's offset, and only one bucket of one key has to
    be sorted by a task.
    """
    cut = df.withColumn("_bucket", F.date_trunc(bucket, F.col(time)))
    by_key = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_rows").over(by_key), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(time)
    numbered = cut.withColumn("_row", F.row_number().over(within))
    joined = numbered.join(offsets, [*keys, "_bucket"])
    return joined.withColumn(POSITION, F.col("_offset") + F.col("_row") - 1).drop("_bucket", "_row", "_offset")


def row_chunks(df: DataFrame, keys: Sequence[str], time: str, halo: int, rows_per_chunk: int) -> DataFrame:
    """Cut every series into chunks of equal row counts, each led by the ``halo`` rows before it.

    Row-frame windows of up to ``halo`` preceding rows then give the same values per
    (key, chunk) as over the whole series; keep the rows where ``_own`` is true.
    """
    if rows_per_chunk < halo:
        raise ValueError("a chunk must be at least as long as its halo")
    placed = series_positions(df, keys, time)
    chunk = F.floor(F.col(POSITION) / F.lit(rows_per_chunk))
    tail = F.col(POSITION) % rows_per_chunk >= rows_per_chunk - halo
    return _spread(placed, chunk, tail)


def range_chunks(df: DataFrame, order: Column, halo: int, width: int) -> DataFrame:
    """Like :func:`row_chunks` for range frames over an integer order value."""
    if width < halo:
        raise ValueError("a chunk must be at least as wide as its halo")
    return _spread(df, F.floor(order / F.lit(width)), F.pmod(order, F.lit(width)) >= width - halo)


def _spread(df: DataFrame, chunk: Column, in_tail: Column) -> DataFrame:
    copies = F.when(
        in_tail,
        F.array(F.struct(chunk.alias("c"), F.lit(True).alias("own")), F.struct((chunk + 1).alias("c"), F.lit(False).alias("own"))),
    ).otherwise(F.array(F.struct(chunk.alias("c"), F.lit(True).alias("own"))))
    spread = df.withColumn("_copy", F.explode(copies))
    return spread.withColumns({CHUNK: F.col("_copy.c"), OWN: F.col("_copy.own")}).drop("_copy")


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OWN)).drop(CHUNK, OWN, POSITION)


def series_window(keys: Sequence[str], order: str | Column, chunked: bool = False) -> WindowSpec:
    parts = [*keys, CHUNK] if chunked else list(keys)
    return Window.partitionBy(*parts).orderBy(order)


def global_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Add the 0-based position in the total order of the whole table.

    A window without partition key would send every row to one task. Here the rows are
    range-sorted over many tasks, each row keeps its task number and its rank inside the
    task (both come out of one increasing id assigned right after the sort), and the
    sorted rows are written once. Adding the sizes of the preceding tasks - one row per
    task - turns this into a global position.

    ``order`` must identify rows uniquely; the unique tail also lets the range
    partitioner split a value shared by many rows.
    """
    task_bits = 33
    sorted_rows = materialise(
        df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "row-index"
    )
    task = F.shiftright(F.col("_id"), task_bits)
    placed = sorted_rows.withColumns({"_task": task, "_rank": F.col("_id") - F.shiftleft(task, task_bits)})
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_task")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return placed.join(starts, "_task").withColumn(name, F.col("_start") + F.col("_rank")).drop("_id", "_task", "_rank", "_start")


def normalised_rank(df: DataFrame, value: str, keys: Sequence[str], name: str = "rank_share") -> DataFrame:
    """Rank of ``value`` scaled to 0..1; ties are settled by ``keys``, a single row gets 0."""
    indexed = global_row_index(df, [F.col(value).asc(), *[F.col(k).asc() for k in keys]], "_index")
    total = indexed.agg(F.count(F.lit(1)).alias("n")).select("n")
    share = F.col("_index") / F.greatest(total.scalar() - 1, F.lit(1))
    return indexed.withColumn(name, share).drop("_index")
