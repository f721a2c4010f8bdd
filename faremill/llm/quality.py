"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic calibration.

Each text becomes ``textstats.FEATURES`` counts-based numbers. Cosines of random projections approximate a
Gaussian kernel on them. Tasks sum their part of the normal equations; the sums of at most ``SUM_TASKS``
tasks meet on the driver, where the ridge weights are solved. Labelled rows kept out of that fit calibrate
the raw scores by pooling adjacent violators over at most ``2 * GRID`` score steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import textstats, wordhash

COSINES = 256
PENALTY = 1e-3
#: Bound of the labelled sample that is fitted; beyond it rows are chosen by a hash of their id.
MOST_LABELLED = 200_000
SUM_TASKS = 8
GRID = 1000
FOLDS, HELD_OUT, CALIBRATE = 5, 0, 1
CUT = 0.3


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    fields = [f for f in docs.select(*carry).schema.fields] if carry else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, data, offsets in wordhash.slices(b.column(1)):
                rows = textstats.features(data, offsets)
                column = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, textstats.FEATURES), pa.int32()), pa.array(rows.reshape(-1)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), column, *[c.slice(first, end - first) for c in b.columns[2:]]], names=["id", "x", *[f"carry_{i}" for i in range(len(carry))]])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    extra = "".join(f", carry_{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    return source.mapInArrow(run, f"id long, x array<float>{extra}")


def fold(id_col: str = "id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, textstats.FEATURES).astype(np.float64)


class Model:
    """Standardisation, projection, weights and calibration; small arrays of fixed size."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(11)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.omega = rng.standard_normal((len(mean), COSINES)) / np.sqrt(len(mean))
        self.phase = rng.uniform(0, 2 * np.pi, COSINES)
        self.weights = np.zeros(COSINES + 1)
        self.steps, self.values = np.array([0.0]), np.array([0.5])

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.column_stack([np.cos(z @ self.omega + self.phase) * np.sqrt(2 / COSINES), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.steps, self.values)


def pool_violators(at: np.ndarray, ones: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing rates with their weighted positions; a half row of each label smooths every pool."""
    pools: list[list[float]] = []
    for a, k, n in zip(at, ones, rows, strict=True):
        pools.append([a * n, k, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.maximum.accumulate([(p[1] + 0.5) / (p[2] + 1) for p in pools])


def fit(features: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality") -> Model:
    """Learn from labelled rows outside the held-out fold; repeated labels of an id count once (the largest)."""
    marked = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id).cast("long").alias("id")).agg(F.max(label_col).cast("double").alias("y"))
    marked = materialise(marked.where(fold() != HELD_OUT), "labels")
    count = marked.count()
    if count > MOST_LABELLED:
        marked = marked.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * MOST_LABELLED / count))
    rows = materialise(features.select("id", "x").join(marked, "id").withColumn("fold", fold()), "labelled")
    size = textstats.FEATURES
    sums = rows.agg(F.count("*").alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(size)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(size)]).first()
    if not sums["n"]:
        return Model(np.zeros(size), np.ones(size))
    model = Model(*(np.array([sums[f"{c}{i}"] for i in range(size)], np.float64) for c in "ms"))

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, target, n = np.zeros((COSINES + 1, COSINES + 1)), np.zeros(COSINES + 1), 0
        for b in batches:
            if b.num_rows:
                c = model.cosines(_matrix(b.column(0)))
                square, target, n = square + c.T @ c, target + c.T @ b.column(1).to_numpy(), n + b.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()], pa.binary()), pa.array([target.tobytes()], pa.binary())], names=["square", "target"])

    parts = rows.where(F.col("fold") != CALIBRATE).select("x", "y").repartition(SUM_TASKS).mapInArrow(normal, "square binary, target binary").collect()
    if parts:
        square = sum(np.frombuffer(p["square"]).reshape(COSINES + 1, -1) for p in parts)
        target = sum(np.frombuffer(p["target"]) for p in parts)
        model.weights = np.linalg.solve(square + PENALTY * square[-1, -1] / COSINES * np.eye(COSINES + 1), target)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                step = np.clip(np.rint(model.raw(_matrix(b.column(0))) * GRID), -GRID // 2, GRID + GRID // 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(step), b.column(1)], names=["step", "y"])

    grid = rows.where(F.col("fold") == CALIBRATE).select("x", "y").mapInArrow(raw, "step long, y double").groupBy("step").agg(F.sum("y").alias("ones"), F.count("*").alias("rows")).orderBy("step").collect()
    if grid:
        model.steps, model.values = pool_violators(*(np.array([r[c] for r in grid], np.float64) for c in ("step", "ones", "rows")))
        model.steps = model.steps / GRID
    return model


def score(features: DataFrame, model: Model) -> DataFrame:
    names = ["id", "score", *features.columns[2:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1)))), *b.columns[2:]], names=names)

    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in features.schema.fields[2:])
    return features.mapInArrow(run, f"id long, score double{extra}")


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and each text's score; one Python worker a task works out features and score of a batch."""
    at, names = docs.columns.index(text_col), [*docs.columns, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = [textstats.features(data, offsets).reshape(-1, textstats.FEATURES) for _, _, data, offsets in wordhash.slices(b.column(at))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(np.concatenate(rows).astype(np.float64)))], names=names)

    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """Per document: id, held_out, score, predicted.

    Scores depend on the text alone; a null or empty text has the features 0 and a score like any other. Labels
    of ids that are no documents, and null labels, are passed over; with no labels at all every score is 0.5.
    Rows of a repeated id are separate documents. Other columns are not read. An empty table gives an empty result.
    """
    features = materialise(text_features(docs, id_col, text_col), "features")
    model = fit(features, labels)
    return score(features, model).select(
        F.col("id").alias(id_col), F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )
