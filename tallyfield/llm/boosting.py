"""Gradient-boosted trees with monotonic constraints, kept as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS, TREES, DEPTH, RATE = 64, 80, 4, 0.15

#: Weight of a leaf's prior and least second-order mass of a child.
SHRINK, LEAST_MASS = 1.0, 3.0


@dataclass
class Forest:
    """Node arrays of all trees; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of every row, all trees in step."""
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        places = np.arange(len(rows))[:, None]
        for _ in range(DEPTH):
            go_right = rows[places, self.feature[at]] > self.threshold[at]
            at = np.where(go_right, self.right[at], self.left[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(rows)))


def _best_split(binned, grad, hess, low, high, monotone):
    """(gain, feature, bin, left value, right value) of the best allowed split, or None."""
    best = None
    g_all, h_all = grad.sum(), hess.sum()
    before = g_all**2 / (h_all + SHRINK)
    for feature in range(binned.shape[1]):
        g_left = np.cumsum(np.bincount(binned[:, feature], grad, BINS))[:-1]
        h_left = np.cumsum(np.bincount(binned[:, feature], hess, BINS))[:-1]
        g_right, h_right = g_all - g_left, h_all - h_left
        left = np.clip(-g_left / (h_left + SHRINK), low, high)
        right = np.clip(-g_right / (h_right + SHRINK), low, high)
        gain = g_left**2 / (h_left + SHRINK) + g_right**2 / (h_right + SHRINK) - before
        allowed = (h_left >= LEAST_MASS) & (h_right >= LEAST_MASS)
        if monotone[feature]:
            allowed &= monotone[feature] * (right - left) >= 0
        gain = np.where(allowed, gain, -np.inf)
        at = int(gain.argmax())
        if gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
            best = gain[at], feature, at, left[at], right[at]
    return best


def fit(rows: np.ndarray, labels: np.ndarray, monotone: list[int]) -> Forest:
    """Logistic boosting on 0/1 labels; monotone has 1, -1 or 0 for each feature."""
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(edge, rows[:, f], side="left") for f, edge in enumerate(edges)], axis=1)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots, share = [], float(np.clip(labels.mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(rows), base)
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        grad, hess = chance - labels, chance * (1 - chance)
        roots.append(len(nodes))
        start = -grad.sum() / (hess.sum() + SHRINK)
        nodes.append([0, 0.0, len(nodes), len(nodes), start])
        level = [(roots[-1], np.arange(len(rows)), -np.inf, np.inf)]
        for _ in range(DEPTH):
            deeper = []
            for node, members, low, high in level:
                found = _best_split(binned[members], grad[members], hess[members], low, high, monotone)
                if found is None or found[2] >= len(edges[found[1]]):
                    continue
                _, feature, at, left, right = found
                children = len(nodes), len(nodes) + 1
                nodes[node][:4] = [feature, edges[feature][at], *children]
                nodes.append([0, 0.0, children[0], children[0], left])
                nodes.append([0, 0.0, children[1], children[1], right])
                goes_right = binned[members, feature] > at
                middle = (left + right) / 2
                bounds = [(low, high), (low, high)]
                if monotone[feature] > 0:
                    bounds = [(low, middle), (middle, high)]
                elif monotone[feature] < 0:
                    bounds = [(middle, high), (low, middle)]
                deeper += [
                    (child, members[side], *bound)
                    for child, side, bound in zip(children, (~goes_right, goes_right), bounds, strict=True)
                ]
            level = deeper
        for node in range(roots[-1], len(nodes)):
            nodes[node][4] *= RATE
        forest = _flat(nodes, roots[-1:], 0.0)
        margin += forest.margin(rows)
    return _flat(nodes, roots, base)


def _flat(nodes: list[list[float]], roots: list[int], base: float) -> Forest:
    feature, threshold, left, right, value = (np.array(column) for column in zip(*nodes, strict=True))
    return Forest(
        feature.astype(np.int64), threshold, left.astype(np.int64), right.astype(np.int64), value,
        np.array(roots, np.int64), base,
    )
