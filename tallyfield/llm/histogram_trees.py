"""Histogram gradient boosting: trees grown leaf by leaf over binned columns, kept as flat arrays."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Bins of a column, trees at most, leaves of a tree, step size.
BINS, MOST_TREES, LEAVES, RATE = 128, 120, 16, 0.15

#: Penalty of leaf values, least second-order mass of a leaf, trees without progress before the end.
SHRINK, LEAST_MASS, PATIENCE = 1.0, 2.0, 12


@dataclass
class Trees:
    """Nodes of all trees side by side; a leaf's children are the leaf itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of rows: every tree goes down one level for all rows at a time."""
        node = np.repeat(self.roots[None, :], len(rows), axis=0)
        row = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            node = np.where(rows[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -700, 700)))


class _Histograms:
    """Sums of gradients and second derivatives by (column, bin) of a set of rows."""

    def __init__(self, binned: np.ndarray):
        self.width = binned.shape[1]
        self.cells = binned.astype(np.int64) + BINS * np.arange(self.width)

    def of(self, members: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
        cells = self.cells[members].ravel()
        both = [np.bincount(cells, np.repeat(part[members], self.width), self.width * BINS) for part in (grad, hess)]
        return np.stack(both).reshape(2, self.width, BINS)


def _split(histogram: np.ndarray) -> tuple[float, int, int] | None:
    """(gain, column, last bin to the left) of the best split."""
    grad, hess = np.cumsum(histogram, axis=2)
    g_all, h_all = grad[0, -1], hess[0, -1]
    g_right, h_right = g_all - grad, h_all - hess
    gain = grad**2 / (hess + SHRINK) + g_right**2 / (h_right + SHRINK) - g_all**2 / (h_all + SHRINK)
    gain = np.where((hess >= LEAST_MASS) & (h_right >= LEAST_MASS), gain, -np.inf)[:, :-1]
    column, at = divmod(int(gain.argmax()), BINS - 1)
    return (float(gain[column, at]), column, at) if gain[column, at] > 1e-6 else None


def _leaf(histogram: np.ndarray) -> float:
    return float(-RATE * histogram[0, 0].sum() / (histogram[1, 0].sum() + SHRINK))


def _grow(histograms: _Histograms, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray, taught: np.ndarray) -> list[list]:
    """Nodes [column, bin, left, right, value] of one tree; the leaf of the greatest gain is split next."""
    whole = histograms.of(taught, grad, hess)
    nodes = [[0, 0, 0, 0, _leaf(whole)]]
    open_leaves: list[tuple] = []

    def offer(node: int, members: np.ndarray, histogram: np.ndarray) -> None:
        if found := _split(histogram):
            heapq.heappush(open_leaves, (-found[0], node, found[1], found[2], members, histogram))

    offer(0, taught, whole)
    leaves = 1
    while open_leaves and leaves < LEAVES:
        _, node, column, at, members, histogram = heapq.heappop(open_leaves)
        goes_left = binned[members, column] <= at
        sides = members[goes_left], members[~goes_left]
        small = int(len(sides[0]) > len(sides[1]))
        counted = histograms.of(sides[small], grad, hess)
        parts = (counted, histogram - counted) if small == 0 else (histogram - counted, counted)
        children = len(nodes), len(nodes) + 1
        nodes[node][:4] = [column, at, *children]
        for child, side, part in zip(children, sides, parts, strict=True):
            nodes.append([0, 0, child, child, _leaf(part)])
            offer(child, side, part)
        leaves += 1
    return nodes


def _depth(nodes: list[list]) -> int:
    depth, most = {0: 0}, 0
    for node, (_, _, left, right, _) in enumerate(nodes):  # children stand behind their parent
        if left != node:
            depth[left] = depth[right] = depth[node] + 1
            most = max(most, depth[left])
    return most


def _loss(margin: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, margin) - labels * margin))


def fit(rows: np.ndarray, labels: np.ndarray, checked: np.ndarray) -> Trees:
    """Logistic boosting on 0/1 labels; rows marked as checked only decide how many trees stay."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS)[1:-1], method="lower")) for column in rows.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, rows.T, strict=True)], axis=1)
    histograms, taught = _Histograms(binned), np.flatnonzero(~checked)
    share = float(np.clip(labels[taught].mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    margin, forest = np.full(len(rows), base), []
    judges = np.flatnonzero(checked) if checked.any() else taught
    best, best_size = _loss(margin[judges], labels[judges]), 0
    while len(forest) < MOST_TREES and len(forest) - best_size < PATIENCE:
        chance = 1 / (1 + np.exp(-margin))
        nodes = _grow(histograms, binned, chance - labels, chance * (1 - chance), taught)
        forest.append(nodes)
        column, at, left, right, value = (np.array(part) for part in zip(*nodes, strict=True))
        node = np.zeros(len(rows), np.int64)
        for _ in range(_depth(nodes)):
            node = np.where(binned[np.arange(len(rows)), column[node]] <= at[node], left[node], right[node])
        margin += value[node]
        if (loss := _loss(margin[judges], labels[judges])) < best:
            best, best_size = loss, len(forest)
    return _flat(forest[:best_size], edges, base)


def _flat(forest: list[list[list]], edges: list[np.ndarray], base: float) -> Trees:
    parts, roots, size = [], [], 0
    for nodes in forest:
        roots.append(size)
        for node, (column, at, left, right, value) in enumerate(nodes):
            inner = left != node and at < len(edges[column])
            threshold = edges[column][at] if inner else np.inf
            parts.append((column, threshold, size + left, size + right, value))
        size += len(nodes)
    # A root that never was split has itself as both children, like any leaf.
    feature, threshold, left, right, value = zip(*parts, strict=True) if parts else ([], [], [], [], [])
    return Trees(
        np.array(feature, np.int64), np.array(threshold, float), np.array(left, np.int64), np.array(right, np.int64),
        np.array(value, float), np.array(roots, np.int64), max(map(_depth, forest), default=0), base,
    )
