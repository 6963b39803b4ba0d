"""SetSketch registers: exponentially spaced truncated minima of hashed sets.

Register i of a set is floor(1 - log_b(x)) cut to [0, q + 1], where x is the least of one
exponential variable of rate a per element. Registers merge by their maxima, and equal ones
grow more likely with the sets' similarity. Values (fixed for all sketches): b = 1.01, a = 20,
q = 65534.
"""

from __future__ import annotations

import numpy as np

from spanloom.llm.words import mix

B, A, Q = 1.01, 20.0, 65534
_STEP = 256


def seeds(m: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 63, m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def registers(elements: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """The registers (uint16) of a set of 64-bit numbers; all zero for an empty set."""
    if not len(elements):
        return np.zeros(len(seed), np.uint16)
    least = np.full(len(seed), ~np.uint64(0))
    for i in range(0, len(elements), _STEP):
        x = elements[i : i + _STEP, None] * seed
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        np.minimum(least, x.min(axis=0), out=least)
    x = -np.log1p(-(least + 0.5) / 2.0**64) / A
    return np.clip(np.floor(1.0 - np.log(x) / np.log(B)), 0, Q + 1).astype(np.uint16)


def merge(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The registers of the union."""
    return np.maximum(u, v)


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (B - 1) / B) / np.log(B)


def similarity(u: np.ndarray, v: np.ndarray, n_u: np.ndarray, n_v: np.ndarray, steps: int = 200) -> np.ndarray:
    """The Jaccard similarity of each pair of rows that is likeliest given how many registers are
    greater, smaller and equal, and given the sizes n_u and n_v; on a grid of `steps` values."""
    up, down = (u > v).sum(axis=1), (u < v).sum(axis=1)
    same = u.shape[1] - up - down
    share_u = n_u / (n_u + n_v)
    share_v = 1.0 - share_u
    top = np.minimum(n_u, n_v) / np.maximum(n_u, n_v)
    best, at = np.full(len(up), -np.inf), np.zeros(len(up))
    for s in range(steps + 1):
        j = np.minimum(s / steps, top)
        p = np.maximum(_share(np.maximum(share_u - share_v * j, 0)), 1e-12)
        q = np.maximum(_share(np.maximum(share_v - share_u * j, 0)), 1e-12)
        like = up * np.log(p) + down * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))
        better = like > best
        best[better], at[better] = like[better], j[better]
    return at


def element_hashes(values: np.ndarray) -> np.ndarray:
    """Hashes of whole numbers, to sketch sets of numbers."""
    return mix(values.astype(np.uint64))
