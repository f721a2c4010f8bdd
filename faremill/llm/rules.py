"""Quality rules: fixed checks of each text, then a log-likelihood ratio of hashed n-grams.

Words and word pairs of every document are hashed to ``BUCKETS`` counts, once for the raw corpus and once for
the trusted part. Both multinomials are smoothed; a document's score is the mean log ratio of its n-grams, so
it doesn't grow with length. Documents below a fixed distance under the trusted mean fail; nothing is drawn
at random. The raw counts and the scores need no join; for the trusted counts, texts that are surely not trusted stay
where they are, and mean and spread come from the thin table of scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import textstats, wordhash

BUCKETS, PARTS = 1 << 15, 1 << 7
SMOOTHING = 1.0
DEVIATIONS = 6.0
#: Bits of the map that spares untrusted texts the shuffle.
BITS = 1 << 27
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Bounds of words, their hashes and first words; buckets of words and of word pairs with their bounds."""
    starts, ends, first = wordhash.word_bounds(data, offsets)
    hashes = wordhash.word_hashes(data, starts, ends, lower=False)
    pairs, pair_first = wordhash.windows(hashes, first, 2)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    return starts, ends, first, hashes, (wordhash.mix(hashes) >> shift).astype(np.int64), (pairs >> shift).astype(np.int64), pair_first


def _maybe_trusted(good: DataFrame) -> Callable[[Column], Column]:
    """A test of ids that all of ``good`` pass, and few others while these are far fewer than ``BITS``.

    Hashes of the ids set bits of a bitmap of fixed size, built by Spark and sent to all tasks.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(BITS)) + 1
    parts = good.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    wide = len(parts[0]["bits"]) if parts else 1
    bits = np.zeros((BITS // (8 * wide) + 1) * wide, np.uint8)
    for r in parts:
        bits[(r["part"] - 1) * wide : r["part"] * wide] = np.frombuffer(r["bits"], np.uint8)
    sent = good.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def has(places: pd.Series) -> pd.Series:
        at = places.fillna(-1).to_numpy(np.int64)
        return pd.Series((at >= 0) & (sent.value[at >> 3] >> (at & 7) & 1 == 1))

    return lambda ids: has(F.when(ids.isNotNull(), F.pmod(F.xxhash64(ids), F.lit(BITS))))


def trusted_texts(source: DataFrame, good: DataFrame) -> DataFrame:
    """The texts of trusted ids. Only rows that pass the bitmap are shuffled, and the join settles them exactly.

    The ids grow with the corpus, so they are never broadcast: the plan is the same at every size.
    """
    maybe = _maybe_trusted(good)
    return source.where(maybe(F.col("id"))).join(good.hint("merge"), "id", "left_semi")


def _counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts: each task sends its counts in ``PARTS`` pieces, which are added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, _, data, offsets in wordhash.slices(b.column(0)):
                for grams in _grams(data, offsets)[4:6]:
                    counts += np.bincount(grams, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([p.tobytes() for p in np.split(counts, PARTS)], pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["part", "counts"])

    pieces = texts.select("text").mapInArrow(run, "part int, counts binary").repartition("part").mapInArrow(add, "part int, counts binary")
    out = np.zeros((PARTS, BUCKETS // PARTS))
    for r in pieces.collect():
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(-1)


def log_ratios(source: DataFrame, good: DataFrame) -> np.ndarray:
    """log(trusted share / raw share) of each bucket, from the counts of all documents."""
    own = _counts(trusted_texts(source, good))
    if not own.sum():
        return np.zeros(BUCKETS)
    raw = _counts(source)
    return np.log((own + SMOOTHING) / (own.sum() + SMOOTHING * BUCKETS)) - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS))


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score.

    ``trusted`` holds ids (column ``id_col``) of trusted documents; without any, only the fixed checks decide.
    A null text has no words and fails them. Rows of a repeated id are separate documents. Other columns are
    not read. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    good = materialise(trusted.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct(), "trusted")
    ratios = log_ratios(source, good)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, data, offsets in wordhash.slices(b.column(1)):
                starts, ends, word_first, hashes, words, pairs, pair_first = _grams(data, offsets)
                counts = np.diff(word_first)
                sums = textstats.per_text(ratios[words], word_first) + textstats.per_text(ratios[pairs], pair_first)
                histogram = textstats.histograms(data, offsets)
                line_hashes, line_first = textstats.lines(data, offsets, starts)
                columns = [
                    counts,
                    histogram[:, ~(textstats._CONTINUES | wordhash.SEPARATOR)].sum(1),
                    histogram[:, textstats.SYMBOLS].sum(1),
                    np.diff(line_first) - textstats.distinct(line_hashes, line_first),
                    textstats.repeated_words(hashes, word_first, WINDOW),
                ]
                score = np.round(sums / np.maximum(counts + np.diff(pair_first), 1), 9)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, end - first), *[pa.array(c.astype(np.int64)) for c in columns], pa.array(score)],
                    names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"],
                )

    rows = materialise(source.mapInArrow(run, "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"), "rules")
    own = rows.where(F.col("n_words") >= LEAST_WORDS).join(good, "id", "left_semi").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("spread")).first()
    least = float("-inf") if own["mean"] is None else round(own["mean"] - DEVIATIONS * own["spread"], 6)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return rows.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (F.col("score") >= least)).alias("kept"), "score"
    )
