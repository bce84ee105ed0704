"""Gradient-boosted trees on small tables of numbers, for operators that train on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees of equal depth as arrays: the feature and cut of each inner node, the value of each leaf."""

    depth: int
    base: float
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0, bins: int = 32, share_seen: float = 1.0) -> Boosted:
    """Logistic loss, second-order leaf values, cuts at quantiles; deterministic in the order of rows.

    A tree looks at `share_seen` of the features, drawn anew for each, so that no few of them decide alone.
    """
    draw = np.random.default_rng(0)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Boosted(depth, float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(q, c, "left") for q, c in zip(cuts, x.T, strict=True)], axis=1)
    margin = np.full(len(x), model.base)
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, curve = y - p, p * (1 - p) + 1e-9
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(x), np.int64)
        seen = np.sort(draw.permutation(len(cuts))[: max(1, round(share_seen * len(cuts)))])
        for k in range(inner):
            own = np.flatnonzero(node == k)
            best, chosen = 1e-6, None
            if len(own):
                g, h = grad[own], curve[own]
                whole = g.sum() ** 2 / (h.sum() + ridge)
                for f in seen:
                    q = cuts[f]
                    gs = np.cumsum(np.bincount(binned[own, f], g, len(q) + 1))
                    hs = np.cumsum(np.bincount(binned[own, f], h, len(q) + 1))
                    gain = gs**2 / (hs + ridge) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + ridge) - whole
                    if len(q) and gain[:-1].max() > best + 1e-9:
                        best, chosen = float(gain[:-1].max()), (f, int(gain[:-1].argmax()))
            right = np.zeros(len(own), bool)
            if chosen:
                feature[k], cut[k] = chosen[0], cuts[chosen[0]][chosen[1]]
                right = binned[own, chosen[0]] > chosen[1]
            node[own] = 2 * k + 1 + right
        leaf = node - inner
        value = rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, curve, inner + 1) + ridge)
        margin += value[leaf]
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(value)
    return model


def calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (logistic regression on one number)."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a * margin + b)))
        w = p * (1 - p) + 1e-6
        g = np.array([((y - p) * margin).sum() - 1e-3 * a, (y - p).sum() - 1e-3 * b])
        h = np.array([[(w * margin**2).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)
