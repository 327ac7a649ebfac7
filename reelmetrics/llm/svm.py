"""Linear support vectors by dual coordinate descent, for small training samples on the driver."""

from __future__ import annotations

import numpy as np


def fit(index: list[np.ndarray], value: list[np.ndarray], y: np.ndarray, width: int, cost: np.ndarray, epochs: int = 20, seed: int = 0) -> np.ndarray:
    """Weights w that minimise |w|^2 / 2 + sum cost * hinge loss over sparse rows; y is +1 or -1.

    Each step solves the dual problem for one row exactly; rows come in a new fixed random
    order in each epoch, and it ends early when no row is far from its optimum. A column of
    ones in the rows serves as the intercept.
    """
    w, alpha = np.zeros(width), np.zeros(len(y))
    norm = np.array([float(v @ v) for v in value])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(y)):
            if norm[i] == 0:
                continue
            at, v = index[i], value[i]
            slope = y[i] * float(w[at] @ v) - 1.0
            a = alpha[i]
            new = min(max(a - slope / norm[i], 0.0), cost[i])
            if new != a:
                worst = max(worst, abs(new - a) * norm[i])
                w[at] += (new - a) * y[i] * v
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits labels (0 or 1) to margins best, with
    a slight pull that keeps separable data finite. The slope is never below zero."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    slope, offset = 1.0, 0.0
    x = np.stack([margin, np.ones(len(margin))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        grad = x @ (p - target)
        hess = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        slope, offset = float(np.clip(slope - np.clip(step[0], -2, 2), 0.0, 50.0)), float(offset - np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-6:
            break
    return slope, offset


def calibrate_many(x: np.ndarray, y: np.ndarray, pull: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic model of several columns, each of which may only speak for label 1,
    and the offset; squared weights count ``pull`` each."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    cost = pull * np.append(np.ones(x.shape[1] - 1), 1e-6)
    for _ in range(rounds):
        p = logistic(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(cost) + 1e-9 * np.eye(len(w)), x.T @ (p - y) + cost * w)
        new = w - np.clip(step, -3, 3)
        new[:-1] = np.maximum(new[:-1], 0)
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
