"""Consistent weighted sampling: signatures whose collision rate is the generalised Jaccard similarity.

For sample d and term k two Gamma(2, 1) variates r and c and a uniform b are drawn, always the same ones for the
same (d, k). A term of weight s has t = floor(ln s / r + b) and the value ln c - r * (t - b + 1); the term of least
value, together with its t, is the sample. Two weighted sets take the same sample with a probability of sum of
smaller weights / sum of larger weights.

Variates come from tables of 2^16 quantiles, indexed by bits of one hash of (d, k), and are then only added and
multiplied: every machine draws the same ones. The samples of a term are right to about one in 2^16, so sets may
have many thousands of terms.
"""

from __future__ import annotations

import numpy as np

from . import wordhash

SAMPLES = 128
#: Rows of sampled terms that a worker remembers, 8 bytes a sample each.
CACHE = 1 << 16
_ROWS = 1 << 8
_SEEDS = np.random.default_rng(19).integers(1, 2**63, SAMPLES, dtype=np.uint64) | np.uint64(1)
_HALF, _MASK = np.uint64(32), np.uint64(0xFFFF)
#: Values are held as whole multiples of this part.
_UNIT = np.float64(2**24)


def _gamma_quantiles() -> np.ndarray:
    """Middles of 2^16 equal parts of Gamma(2, 1), whose distribution is 1 - (1 + x) e^-x, by bisection."""
    share = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(1 << 16), np.full(1 << 16, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        under = -np.expm1(-middle) - middle * np.exp(-middle) < share
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return (low + high) / 2


_R = np.round(_gamma_quantiles() * 2**20) / 2**20
_LN_C = np.round(np.log(_gamma_quantiles()) * 2**20) / 2**20


def sampled(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each term and sample its value, in the upper half of 64 bits, over a hash of the term and its t."""
    out = np.empty((len(hashes), SAMPLES), np.uint64)
    logs = np.round(np.log(weights) * 2**20) / 2**20
    for begin in range(0, len(hashes), _ROWS):
        part = slice(begin, begin + _ROWS)
        bits = wordhash.mix(hashes[part, None] * _SEEDS)
        r, ln_c = _R.take(bits & _MASK), _LN_C.take((bits >> np.uint64(16)) & _MASK)
        shift = ((bits >> _HALF) & _MASK).astype(np.float64)
        shift = (shift + 0.5) / 2**16
        # Of weight 1, t is 0 for every sample.
        t = np.floor(logs[part, None] / r + shift) if logs[part].any() else 0.0
        value = ((ln_c - r * (t - shift + 1) + 192) * _UNIT).astype(np.uint64)
        ids = hashes[part, None] * _SEEDS[0] + (t.astype(np.int64).view(np.uint64) * _SEEDS[1] if isinstance(t, np.ndarray) else np.uint64(0))
        out[part] = (value << _HALF) | (wordhash.mix(ids) >> _HALF)
    return out


class Sampler:
    """Signatures of weighted sets; rows of terms met lately are kept, up to ``CACHE`` of them."""

    def __init__(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.rows = np.empty((CACHE, SAMPLES), np.uint64)

    def _table(self, keys: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Places in ``rows`` of distinct, sorted terms at their weights, at most ``CACHE`` of them; missing ones are added."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        missing = np.flatnonzero(~known)
        missing = missing[np.argsort(weights[missing], kind="stable")]
        if len(self.keys) + len(missing) > CACHE:
            # Only the terms asked for now stay.
            kept = self.slots[at[known]]
            self.rows[: len(kept)] = self.rows[kept]
            self.keys, self.slots = keys[known], np.arange(len(kept))
        free = len(self.keys) + np.arange(len(missing))
        self.rows[len(self.keys) : len(self.keys) + len(missing)] = sampled(hashes[missing], weights[missing])
        keys_now, slots_now = np.concatenate([self.keys, keys[missing]]), np.concatenate([self.slots, free])
        order = np.argsort(keys_now, kind="stable")
        self.keys, self.slots = keys_now[order], slots_now[order]
        return self.slots[np.searchsorted(self.keys, keys)]

    def signatures(self, hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """SAMPLES numbers of 16 bits for each set: ``bounds`` has its first term and one more; empty sets have all bits set."""
        out = np.full((len(bounds) - 1, SAMPLES), np.iinfo(np.uint64).max, np.uint64)
        keys = wordhash.mix(hashes + weights.view(np.uint64) * wordhash._PLACE[6])
        distinct, first, of = np.unique(keys, return_index=True, return_inverse=True)
        for begin in range(0, len(distinct), CACHE):
            part = slice(begin, begin + CACHE)
            at = self._table(distinct[part], hashes[first[part]], weights[first[part]])
            inside = np.flatnonzero((of >= begin) & (of < begin + CACHE)) if len(distinct) > CACHE else np.arange(len(of))
            places, limits = at[of[inside] - begin], np.searchsorted(inside, bounds)
            for i in np.flatnonzero(np.diff(limits)):
                for low in range(limits[i], limits[i + 1], CACHE):
                    np.minimum(out[i], self.rows[places[low : min(low + CACHE, limits[i + 1])]].min(0), out=out[i])
        return (out & _MASK).astype(">u2")
