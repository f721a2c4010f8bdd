"""Statistics of whole texts, slice by slice in numpy."""

from __future__ import annotations

import numpy as np

from . import wordhash

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_CONTINUES = np.arange(256) >> 6 == 2


def histograms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of each byte value, a row a text."""
    texts = len(offsets) - 1
    owner = np.repeat(np.arange(texts) * 256, np.diff(offsets))
    return np.bincount(owner + data, minlength=256 * texts).reshape(texts, 256)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over each text's run of values."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of distinct hashes in each text's run."""
    return np.array([len(np.unique(hashes[a:b])) if b - a > 1 else b - a for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.int64)


def lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines that hold a word, and each text's first such line (one more at the end)."""
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], breaks + 1]))
    begin = begin[begin < len(data)]
    stop = np.concatenate([begin[1:], [len(data)]]) if len(begin) else begin
    # A line ends before its line break, or where the next text begins.
    end = np.where((stop > begin) & (data[np.maximum(stop - 1, 0)] == 10), stop - 1, stop) if len(begin) else stop
    full = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end = begin[full], end[full]
    return wordhash.word_hashes(data, begin, end, lower=False), np.searchsorted(begin, offsets)


def repeated_words(hashes: np.ndarray, first: np.ndarray, size: int = 8) -> np.ndarray:
    """Words of each text that lie in a run of ``size`` words found twice or more in it."""
    runs, bounds = wordhash.windows(hashes, first, size)
    counts = np.diff(bounds)
    out = np.zeros(len(counts), np.int64)
    for t in np.flatnonzero(counts > 1):
        own = runs[bounds[t] : bounds[t + 1]]
        order = np.argsort(own, kind="stable")
        ranked = own[order]
        same = ranked[1:] == ranked[:-1]
        if same.any():
            again = np.zeros(len(own), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            change = np.zeros(len(own) + size, np.int64)
            at = np.flatnonzero(again)
            np.add.at(change, at, 1)
            np.add.at(change, at + size, -1)
            out[t] = (np.cumsum(change) > 0).sum()
    return out


FEATURES = 24


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shape of each text, from counts alone: a row of FEATURES numbers; zeros for an empty one."""
    h = histograms(data, offsets).astype(np.float64)
    size = np.diff(offsets)
    starts, ends, first = wordhash.word_bounds(data, offsets)
    hashes = wordhash.word_hashes(data, starts, ends)
    words, long = np.diff(first), (ends - starts).astype(np.float64)
    n, w = np.maximum(size, 1), np.maximum(words, 1)
    upper, lower, digit = h[:, 65:91].sum(1), h[:, 97:123].sum(1), h[:, 48:58].sum(1)
    letters = np.maximum(upper + lower, 1)
    is_upper = (data >= 65) & (data <= 90)
    caps = np.concatenate([[0], np.cumsum(is_upper)])
    caps_in = caps[ends] - caps[starts]
    last, initial = data[ends - 1] if len(ends) else data[:0], data[starts] if len(starts) else data[:0]
    alnum = np.zeros(256, bool)
    alnum[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    stop = np.zeros(256, bool)
    stop[[ord(c) for c in ".,;:!?"]] = True
    p = h / n[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    line_hashes, line_first = lines(data, offsets, starts)
    line_count = np.diff(line_first)
    share = lambda mask: per_text(mask, first) / w
    mean = per_text(long, first) / w
    out = np.column_stack(
        [
            np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(per_text(long * long, first) / w - mean**2, 0)),
            upper / letters, digit / n, (h[:, 9:14].sum(1) + h[:, 32]) / n, h[:, [ord(c) for c in ".,"]].sum(1) / w,
            h[:, [ord(c) for c in "!?"]].sum(1) / w, h[:, SYMBOLS].sum(1) / w, h[:, [ord(c) for c in "{}[]()=_/\\~^@+`"]].sum(1) / w,
            h[:, [ord(c) for c in "\"';:-"]].sum(1) / w, h[:, 128:].sum(1) / n, h[:, 10] / w, distinct(hashes, first) / w,
            distinct(line_hashes, line_first) / np.maximum(line_count, 1), entropy, np.log1p(line_count), share(caps_in > 1),
            share((initial >= 65) & (initial <= 90)), share(~alnum[last] & ~stop[last]), share(long == 1), share(long > 20),
            h[:, [ord(c) for c in "aeiouAEIOU"]].sum(1) / letters,
        ]
    )
    out[size == 0] = 0
    return out.astype(np.float32)
