"""SetSketch registers: exponentially spaced, truncated minima of exponential variates.

Register j of a set is floor(OFFSET - log_BASE(E_j)), held to 0..255, where E_j is the smallest of one
Exp(1) variate for each element. Registers of a union are the element-wise maxima, so sketches merge;
two sets agree in a register with a probability slightly above their Jaccard similarity, so runs of
registers serve as band keys.
"""

from __future__ import annotations

import numpy as np

BASE = 1.1
OFFSET = 27
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
#: A pair is dismissed if similarities at or above the threshold are this many nats less likely than the best one.
NATS = 13.0

_FACTORS = np.random.default_rng(77).integers(1, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def sketches(runs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers (texts x REGISTERS, uint8) of texts' shingle runs; zeros for texts without any."""
    out = np.zeros((len(bounds) - 1, REGISTERS), np.uint8)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if not len(full):
        return out
    low, high, at = (runs & np.uint64(0xFFFFFFFF)).astype(np.uint32), (runs >> np.uint64(32)).astype(np.uint32), bounds[full]
    least = np.empty((len(full), REGISTERS), np.uint32)
    each = np.empty_like(low)
    for j, f in enumerate(_FACTORS):
        np.multiply(low if j % 2 else high, f, out=each)
        np.minimum.reduceat(each, at, out=least[:, j])
    variate = -np.log1p(-(least + 0.5) / 2**32)
    out[full] = np.clip(np.floor(OFFSET - np.log(variate) / np.log(BASE)), 0, 255)
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """For each row its BANDS keys: the band's number and its registers, packed without loss."""
    parts = registers.reshape(-1, BANDS, ROWS).astype(np.int64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.int64), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = (key << 8) | parts[:, :, i]
    return key


def plausible(a: np.ndarray, n_a: int, b: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """Which rows of ``b`` may reach the similarity ``least`` with ``a``, by the joint likelihood of both sketches.

    The counts of larger, smaller and equal registers are multinomial given the similarity and the two
    (exactly known) set sizes; the best similarity overall is compared with the best one of at least ``least``.
    """
    ok = np.minimum(n_b, n_a) >= least * np.maximum(n_b, n_a)
    at = np.flatnonzero(ok)
    equal = (b[at] == a).sum(1)
    # At ``least`` = 0.75 fewer than half equal registers has a chance below 1e-13; this only saves work.
    at, equal = (x[equal >= least * 0.66 * len(a)] for x in (at, equal))
    ok[:] = False
    if not len(at):
        return ok
    more = (b[at] < a).sum(1)
    fewer = len(a) - more - equal
    u = (n_a / (n_a + n_b[at]))[:, None]
    grid = np.linspace(0.02, 1, 50)
    most = np.minimum(u / (1 - u), (1 - u) / u)
    j = np.minimum(grid[None], most)
    rate = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    p, q = np.maximum(rate(u - (1 - u) * j), 1e-9), np.maximum(rate(1 - u - u * j), 1e-9)
    like = more[:, None] * np.log(p) + fewer[:, None] * np.log(q) + equal[:, None] * np.log(np.maximum(1 - p - q, 1e-9))
    high = np.where(j >= least - 1e-9, like, -np.inf).max(1)
    ok[at] = like.max(1) - high <= NATS
    return ok
