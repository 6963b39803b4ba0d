"""Gradient-boosted trees on a small sample in numpy, and the same trees as one SQL expression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from spanloom.llm.learn import sigmoid


@dataclass
class Trees:
    base: float
    #: Each tree is nested (feature, limit, left, right) with a float at the leaves; left where value <= limit.
    trees: list
    #: Platt's scale and shift.
    scale: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        def walk(node, rows):
            if isinstance(node, float):
                return np.full(len(rows), node)
            f, limit, a, b = node
            left = x[rows, f] <= limit
            out = np.empty(len(rows))
            out[left], out[~left] = walk(a, rows[left]), walk(b, rows[~left])
            return out

        return self.base + sum((walk(t, np.arange(len(x))) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * self.margin(x) + self.shift)

    def sql(self, names: list[str]) -> str:
        """The probability as a SQL expression of the features."""

        def walk(node) -> str:
            if isinstance(node, float):
                return f"{node!r}D"
            f, limit, a, b = node
            return f"(case when {names[f]} <= {limit!r}D then {walk(a)} else {walk(b)} end)"

        total = " + ".join([f"{self.base!r}D", *map(walk, self.trees)])
        return f"(1D / (1D + exp(-({self.scale!r}D * ({total}) + {self.shift!r}D))))"


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, leaf: int = 8) -> Trees:
    """Boosts logistic loss; splits are at up to 24 quantiles of each feature."""
    rate0 = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = Trees(float(np.log(rate0 / (1 - rate0))), [])
    limits = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 24), method="lower")) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    margin = np.full(len(x), model.base)
    for _ in range(trees if len(x) else 0):
        p = sigmoid(margin)
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)

        def grow(rows: np.ndarray, left_depth: int, g=g, h=h):
            total_g, total_h = g[rows].sum(), h[rows].sum()
            best, at = 1e-6, None
            if left_depth and len(rows) >= 2 * leaf:
                for f, cuts in enumerate(limits):
                    if len(cuts) < 2:
                        continue
                    own = np.searchsorted(cuts, x[rows, f])
                    sg = np.cumsum(np.bincount(own, g[rows], len(cuts) + 1))[:-1]
                    sh = np.cumsum(np.bincount(own, h[rows], len(cuts) + 1))[:-1]
                    sn = np.cumsum(np.bincount(own, minlength=len(cuts) + 1))[:-1]
                    gain = sg**2 / (sh + 1) + (total_g - sg) ** 2 / (total_h - sh + 1) - total_g**2 / (total_h + 1)
                    gain[(sn < leaf) | (len(rows) - sn < leaf)] = 0
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, at = gain[k], (f, float(cuts[k]))
            if at is None:
                return float(-rate * total_g / (total_h + 1))
            f, limit = at
            side = x[rows, f] <= limit
            return f, limit, grow(rows[side], left_depth - 1), grow(rows[~side], left_depth - 1)

        tree = grow(np.arange(len(x)), depth)
        model.trees.append(tree)
        margin += Trees(0.0, [tree]).margin(x)
    return model
