"""Small decision trees, grown on the driver from small tables."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Node(NamedTuple):
    """Rows with ``feature`` at most ``cut`` go left; a leaf has no feature and a value."""

    value: float
    feature: int = -1
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int, least: int, weight: np.ndarray | None = None) -> Node:
    """A tree that lowers the weighted squared error most at each cut; ties take the first
    feature and the smallest cut. Leaves have ``least`` rows or more."""
    weight = np.ones(len(y)) if weight is None else weight
    total = weight.sum()
    value = float((weight * y).sum() / total) if total > 0 else 0.0
    if depth == 0 or len(y) < 2 * least or np.ptp(y) == 0:
        return Node(value)
    best = (1e-12, -1, 0.0)
    for f in range(x.shape[1]):
        by = np.argsort(x[:, f], kind="stable")
        v, w, wy = x[by, f], weight[by], (weight * y)[by]
        cw, cy = np.cumsum(w), np.cumsum(wy)
        n = np.arange(1, len(v))
        ok = (v[1:] > v[:-1]) & (n >= least) & (len(v) - n >= least) & (cw[:-1] > 0) & (total - cw[:-1] > 0)
        if not ok.any():
            continue
        k = np.flatnonzero(ok)
        gain = cy[k] ** 2 / cw[k] + (cy[-1] - cy[k]) ** 2 / (total - cw[k]) - cy[-1] ** 2 / total
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = (float(gain[at]), f, float((v[k[at]] + v[k[at] + 1]) / 2))
    if best[1] < 0:
        return Node(value)
    _, f, cut = best
    left = x[:, f] <= cut
    parts = [grow(x[m], y[m], depth - 1, least, weight[m]) for m in (left, ~left)]
    return Node(value, f, cut, *parts)


def predict(node: Node, row) -> float:
    while node.left is not None:
        node = node.left if row[node.feature] <= node.cut else node.right
    return node.value
