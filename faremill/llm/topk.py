"""Exact top-k by inner product with pivot-table elimination.

Every vector's distances to a fixed set of pivots are worked out once. With |q|, |v| and distances known,
|d(q,p) - d(v,p)| bounds the distance of q and v from below for each pivot p, so the inner product
(|q|^2 + |v|^2 - d(q,v)^2) / 2 from above. Vectors lie in blocks by nearest pivot; block rings (least and
largest distance to each pivot) give a bound for the whole block. A query first meets its home block, whose
k-th score is its threshold; it is sent on only to blocks whose bound reaches it, and there evaluates
candidates in the order of their own bounds until the next one can no longer enter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .arrow_groups import groups

PIVOTS = 16
#: Bound of the sample that pivots and first thresholds come from.
SAMPLE = 8192
STEP = 128
#: Slack for rounding in float64 bounds; scores themselves are exact integers.
SLACK = 1e-6


def _unpack(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Arrays of whole numbers as rows; shorter ones are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), flat.dtype)
    at = np.repeat(np.arange(len(lengths)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = x.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * x @ p.T, 0))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first pivots of a bounded sample."""
    chosen = [0]
    near = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(sample, sample[chosen[-1]][None])[:, 0])
    return sample[chosen]


def _evaluate(q: np.ndarray, qd: np.ndarray, own: np.ndarray, least: np.ndarray, x: np.ndarray, xd: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, id, score) of each query's k best in a block, among those that reach ``least``.

    Candidates are taken in steps along their distance to the pivot that spreads them most. Steps come in the
    order of their bounds; a query drops out of every step whose bound is under its threshold, and thresholds
    rise as scores come in.
    """
    least, square_q, square_x = least.copy(), (q.astype(np.float64) ** 2).sum(1), (x.astype(np.float64) ** 2).sum(1)
    order = np.argsort(xd[:, xd.std(0).argmax()], kind="stable")
    steps = [order[i : i + STEP] for i in range(0, len(order), STEP)]
    bounds = np.empty((len(q), len(steps)))
    for j, s in enumerate(steps):
        apart = np.maximum(np.maximum(xd[s].min(0) - qd, qd - xd[s].max(0)).max(1), 0)
        bounds[:, j] = (square_q + square_x[s].max() - apart**2) / 2
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    q_exact, x_exact = _exact(q, x)
    for j in np.argsort(-bounds.mean(0), kind="stable"):
        s = steps[j]
        asked = np.flatnonzero(bounds[:, j] >= least - SLACK * (1 + np.abs(least)))
        if not len(asked):
            continue
        scores = q_exact[asked] @ x_exact[s].T
        other = ids[s][None] != own[asked][:, None]
        rows, columns = np.nonzero((scores >= least[asked][:, None]) & other)
        found.append((asked[rows], ids[s][columns], scores[rows, columns].astype(np.int64)))
        if len(s) > k:
            kth = np.partition(np.where(other, scores.astype(np.float64), -np.inf), len(s) - k, axis=1)[:, len(s) - k]
            least[asked] = np.maximum(least[asked], kth)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, near, scores = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((near, -scores, at))
    at, near, scores = at[order], near[order], scores[order]
    best = np.arange(len(at)) - np.searchsorted(at, at) < k
    return at[best], near[best], scores[best]


def _exact(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as float64 if every product sum is then exact, else as they are."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    return (q.astype(np.float64), x.astype(np.float64)) if most < 2**53 else (q, x)


def top_k(vectors: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, is_query: Column | None = None, pivots: int = PIVOTS) -> DataFrame:
    """Per query its k best other rows: query_id, rank from 1, vec_id, score.

    Components become floor(scale * x). Vectors that are null or hold a null or a non-finite component take no
    part; shorter vectors are filled with zeros. Rows with the query's own id are not its candidates. Equal
    scores go to the smaller id. With fewer candidates than k all come. Other columns are not read. An empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    asked = (F.col(id_col) % 20 == 0) if is_query is None else is_query
    usable = F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & ~F.coalesce(F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
    whole = vectors.where(usable).select(
        F.col(id_col).cast("long").alias("id"), asked.alias("asked"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v")
    )
    whole = materialise(whole, "vectors")
    facts = whole.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("dims")).first()
    n, dims = facts["n"], max(1, facts["dims"])
    schema = "query_id long, rank int, vec_id long, score long"
    if n == 0:
        return spark.createDataFrame([], schema)
    # A bounded sample by hash; the share is exact enough, and the limit holds it to its bound.
    sample = whole.where(F.pmod(F.xxhash64("id"), F.lit(n)) < SAMPLE).select("id", "v").distinct().limit(2 * SAMPLE).collect() or whole.select("id", "v").limit(1).collect()
    sample = sorted(sample, key=lambda r: (r["id"], list(r["v"])))
    sample_ids, rows = np.array([r["id"] for r in sample], np.int64), np.zeros((len(sample), dims), np.int64)
    for i, r in enumerate(sample):
        rows[i, : len(r["v"])] = r["v"]
    table = choose_pivots(rows, pivots)
    # Blocks of about twice the square root of the table: their rings stay far smaller than the table.
    block_rows = max(64, math.ceil(2 * math.sqrt(n)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = _distances(_unpack(b.column(2), dims), table)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(d.argmin(1), pa.int32()), pa.array(list(d), pa.list_(pa.float64()))], names=["id", "asked", "v", "pivot", "d"])

    measured = materialise(whole.select("id", "asked", "v").mapInArrow(measure, "id long, asked boolean, v array<long>, pivot int, d array<double>"), "pivot-table")
    sizes = {r["pivot"]: r["count"] for r in measured.groupBy("pivot").count().collect()}
    parts = F.create_map(*[F.lit(x) for p, c in sizes.items() for x in (p, math.ceil(c / block_rows))])
    most = max(math.ceil(c / block_rows) for c in sizes.values())
    blocked = measured.withColumn("block", (F.col("pivot") * most + F.pmod(F.xxhash64("id"), F.element_at(parts, F.col("pivot")))).cast("int"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rings = blocked.groupBy("block").agg(
        F.max(norm).alias("norm"), *[f(F.col("d")[i]).alias(f"{s}{i}") for i in range(len(table)) for s, f in (("lo", F.min), ("hi", F.max))]
    ).collect()
    names = np.array([r["block"] for r in rings])
    norms = np.array([r["norm"] for r in rings])
    low, high = (np.array([[r[f"{s}{i}"] for i in range(len(table))] for r in rings]) for s in ("lo", "hi"))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["block"]):
            asked = np.flatnonzero(g["asked"].to_numpy())
            if not len(asked):
                continue
            x, ids, d = _unpack(g["v"], dims), g["id"].to_numpy(), _unpack(g["d"], len(table))
            least = np.full(len(asked), -np.inf)
            if len(sample_ids) > k:
                # The k-th best of the sample's other rows is reached by the k-th best of all.
                q, r = _exact(x[asked], rows)
                scores = np.where(sample_ids[None] != ids[asked][:, None], (q @ r.T).astype(np.float64), -np.inf)
                least = np.partition(scores, len(sample_ids) - k, axis=1)[:, len(sample_ids) - k]
            at, near, scores = _evaluate(x[asked], d[asked], ids[asked], least, x, d, ids, k)
            bounds = np.searchsorted(at, np.arange(len(asked) + 1))
            for i in np.flatnonzero(np.diff(bounds) == k):
                least[i] = max(least[i], scores[bounds[i + 1] - 1])
            square, block = (x[asked].astype(np.float64) ** 2).sum(1), g["block"][0].as_py()
            targets = []
            for i, q in enumerate(asked):
                apart = np.maximum(np.maximum(low - d[q], d[q] - high).max(1), 0)
                reach = (square[i] + norms - apart**2) / 2
                targets.append(names[(reach >= least[i] - SLACK * (1 + abs(least[i]))) & (names != block)].tolist())
            listed = lambda values, kind: pa.array([v.tolist() for v in np.split(values, bounds[1:-1])], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[asked]), pa.array(list(x[asked]), pa.list_(pa.int64())), pa.array(list(d[asked]), pa.list_(pa.float64())), pa.array(least), pa.array(targets, pa.list_(pa.int32())), listed(near, pa.int64()), listed(scores, pa.int64())],
                names=["id", "v", "d", "least", "blocks", "ids", "scores"],
            )

    dealt = blocked.repartition("block").sortWithinPartitions("block", "id")
    begun = materialise(dealt.mapInArrow(home, "id long, v array<long>, d array<double>, least double, blocks array<int>, ids array<long>, scores array<long>"), "home-blocks")
    visits = begun.select("id", F.lit(True).alias("visit"), "v", "d", "least", F.explode("blocks").alias("block"))
    hosts = blocked.select("id", F.lit(False).alias("visit"), "v", "d", F.lit(0.0).alias("least"), "block")
    both = hosts.unionByName(visits).repartition("block").sortWithinPartitions("block", "visit", "id")

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["block"]):
            visit = g["visit"].to_numpy()
            if not visit.any():
                continue
            v, d, ids = _unpack(g["v"], dims), _unpack(g["d"], len(table)), g["id"].to_numpy()
            asked = ids[visit]
            at, near, scores = _evaluate(v[visit], d[visit], asked, g["least"].to_numpy()[visit], v[~visit], d[~visit], ids[~visit], k)
            yield pa.RecordBatch.from_arrays([pa.array(asked[at]), pa.array(near), pa.array(scores)], names=["query_id", "vec_id", "score"])

    found = both.mapInArrow(away, "query_id long, vec_id long, score long")
    near = begun.select(F.col("id").alias("query_id"), F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query_id", "x.ids", "x.scores")
    every = found.union(near)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
