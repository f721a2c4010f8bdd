"""Periodic runs of words by seed and extend.

A run is a stretch of words with smallest period q, ``powers`` times q words long or longer, that no neighbouring
word extends. Along the diagonal of lag q (word i against word i + q) it is a stretch of matches, at least its
guaranteed overlap long: the least length less q. Lags are taken by octaves, from ``low`` up to ``2 * low - 1``:

1. Index: all k-grams of the text, k being the least overlap that any lag of the octave guarantees. A gram that
   occurs once in its text can be in no run of this octave or a later one, and drops out.
2. Seeds: each occurrence of a gram and the next one in the same text, if their lag is in the octave. Within a
   run of smallest period q, a gram of at least q words recurs after exactly q words (an earlier recurrence would
   make the period smaller), so neighbouring occurrences are enough and pairs never outnumber the words.
3. Extend: a seed grows along its diagonal in both directions, word by word, to the ends of the run. What a lag's
   diagonal has covered furthest is kept, and seeds inside it are passed over.

A row's work is its own words only; rows are never brought together, so there is no shuffle and no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash

LEAST, POWERS = 6, 4
_LEFT, _RIGHT, _HEAD, _TAIL, _TEXT = wordhash._PLACE[:5]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _reach(words: np.ndarray, at: int, lag: int, step: int, stop: int) -> int:
    """First position from ``at`` on in direction ``step`` whose word differs from the one ``lag`` later, or ``stop``."""
    size = 16
    while at != stop:
        size = min(2 * size, abs(stop - at))
        near = np.arange(at, at + step * size, step)
        differs = np.flatnonzero(words[near] != words[near + lag])
        if len(differs):
            return int(near[differs[0]])
        at += step * size
    return stop


def _extended(words: np.ndarray, bounds: np.ndarray, text: np.ndarray, at: np.ndarray, lags: np.ndarray, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """(text, start, length, lag) of the stretches that seeds lie in, each once."""
    order = np.lexsort((at, lags))
    at, lags = at[order], lags[order]
    limits = np.flatnonzero(np.concatenate([[True], lags[1:] != lags[:-1], [True]])) if len(at) else [0]
    for begin, end in zip(limits[:-1], limits[1:], strict=True):
        lag, own, i = int(lags[begin]), at[begin:end], 0
        while i < len(own):
            seed = int(own[i])
            first, last = int(bounds[text[seed]]), int(bounds[text[seed] + 1])
            start = _reach(words, seed, lag, -1, first - 1) + 1
            furthest = _reach(words, seed, lag, 1, last - lag)
            if furthest > start:
                yield int(text[seed]), start - first, furthest - start + lag, lag
            # Seeds that end within the covered stretch are the same one.
            i = max(i + 1, int(np.searchsorted(own, furthest - overlap, "right")))


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, powers: int = POWERS) -> np.ndarray:
    """Runs of all texts: rows of (text, start, length, period) by text, start and period.

    ``words`` holds a hash a word, the texts one after another; ``bounds`` has each text's first word and one more
    at the end. ``powers`` is 3 or more: below that, neighbouring occurrences don't tell every run.
    """
    if powers < 3:
        raise ValueError("runs need three periods or more")
    count, sizes = len(words), np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    room = bounds[1:][text] - np.arange(count)
    live, grams, width, low = np.arange(count), words, 1, 1
    found: dict[tuple[int, int, int], int] = {}
    while len(live) and powers * low <= sizes.max():
        octave = np.arange(low, 2 * low)
        overlap = int((np.maximum(least, powers * octave) - octave).min())
        while 2 * width <= overlap:
            ahead = np.zeros(count, np.uint64)
            ahead[: max(count - width, 0)] = grams[width:]
            grams, width = wordhash.mix(grams * _LEFT + ahead * _RIGHT), 2 * width
        live = live[room[live] >= overlap]
        key = wordhash.mix(grams[live] * _HEAD + grams[live + overlap - width] * _TAIL + text[live].astype(np.uint64) * _TEXT)
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        at, after = live[order[:-1][same]], live[order[1:][same]]
        fits = (after - at >= low) & (after - at < 2 * low)
        for t, start, length, lag in _extended(words, bounds, text, at[fits], (after - at)[fits], overlap):
            if length >= max(least, powers * lag):
                found.setdefault((t, start, length), lag)
        live = np.unique(np.concatenate([at, after]))
        low *= 2
    rows = np.array(sorted((t, s, n, p) for (t, s, n), p in found.items()), np.int64).reshape(-1, 4)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _kept(runs: np.ndarray, size: int) -> np.ndarray:
    """Which words of a text stay: those that no run repeats."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 1] + runs[:, 3], 1)
    np.add.at(change, runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(change[:-1]) == 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, powers: int = POWERS) -> DataFrame:
    """Per document: id, n_words, runs (array of start, length, period by start and period), collapsed text.

    The collapsed text is the words left when each run keeps its first period only, joined by one space. A null
    or empty text has no words, no runs and an empty collapsed text. Rows of a repeated id are separate documents.
    Two runs of one start differ in period; equal stretches count once, with their smallest period. Other columns
    are not read. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in wordhash.slices(batch.column(1)):
                starts, ends, bounds = wordhash.word_bounds(data, offsets)
                runs = find_runs(wordhash.word_hashes(data, starts, ends, lower=False), bounds, least, powers)
                limits = np.searchsorted(runs[:, 0], np.arange(end - first + 1))
                texts = []
                for t, (a, b) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
                    words = data[offsets[t] : offsets[t + 1]].tobytes().split()
                    if b > a:
                        words = [words[i] for i in np.flatnonzero(_kept(runs[a:b], len(words)))]
                    texts.append(b" ".join(words).decode())
                parts = [pa.array(np.ascontiguousarray(runs[:, c])) for c in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(_RUN))),
                        pa.array(texts, pa.string()),
                    ],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    out = source.mapInArrow(run, f"id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)
