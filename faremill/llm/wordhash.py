"""Words and shingles of whole texts as numpy arrays of 64-bit hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z are lowered on request.
Texts are handled in slices of about ``SLICE_BYTES``, so the memory of a task follows the slice
(and the longest single text), not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base or of its inverse modulo 2^64, kept between calls."""
    have = _powers.get(which)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        factors = np.full(size, _BASE if which == "base" else _INVERSE, np.uint64)
        factors[0] = 1
        have = _powers[which] = np.multiply.accumulate(factors)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of rows; null is an empty text."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in bytes, and for each text the index of its first word (one more at the end)."""
    gap = separator[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner], after[inner - 1] = True, True
    starts = np.flatnonzero(before & ~gap)
    ends = np.flatnonzero(after & ~gap) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """One 64-bit hash a word: a polynomial in its bytes, so that equal words have equal hashes anywhere."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    terms = (_BYTE_LOWER if lower else _BYTE)[data] * _power("inverse", len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("base", len(data))[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text, in order, and each text's first run (one more at the end)."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts) + np.repeat(first[:-1], counts)
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        out += hashes[at + j] * _PLACE[j]
    return mix(out), bounds


def shingle_runs(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of each text with repeats; a text of fewer words has its whole sequence as the only one."""
    starts, ends, first = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    runs, bounds = windows(hashes, first, size)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return runs, bounds
    whole = np.zeros(len(short), np.uint64)
    for j in range(size - 1):
        has = counts[short] > j
        whole[has] += hashes[first[short[has]] + j] * _PLACE[j]
    whole = mix(whole + _PLACE[size + counts[short]])
    return np.insert(runs, bounds[short], whole), bounds + np.concatenate([[0], np.cumsum((counts > 0) & (counts < size))])


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for _, _, data, offsets in slices(texts):
        runs, bounds = shingle_runs(data, offsets, size)
        out += [np.unique(runs[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out
