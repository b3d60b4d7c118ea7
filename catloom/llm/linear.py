"""Linear support vector machines, fitted on the driver from a bounded sample."""

from __future__ import annotations

import numpy as np

#: A row of a sample: indexes of its features and their values.
Row = tuple[np.ndarray, np.ndarray]


def dual_descent(rows: list[Row], signs: np.ndarray, size: int, cost: np.ndarray, rounds: int = 20, seed: int = 0) -> np.ndarray:
    """Weights and (last) bias of a hinge-loss machine, by dual coordinate descent.

    Each row's dual variable is solved for exactly in turn, in a new order each
    round, and stays within 0 and the row's cost.
    """
    w, alpha = np.zeros(size + 1), np.zeros(len(rows))
    norms = np.array([v @ v + 1.0 for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, v = rows[i]
            slack = signs[i] * (w[at] @ v + w[-1]) - 1
            new = min(max(alpha[i] - slack / norms[i], 0.0), cost[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                alpha[i] = new
                w[at] += step * v
                w[-1] += step
                moved = max(moved, abs(step))
        if moved < 1e-4 * cost.max():
            break
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def platt(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (maximum likelihood, smoothed targets)."""
    n1, n0 = positive.sum(), (~positive).sum()
    aim = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(a * margins + b)
        g = np.array([(p - aim) @ margins, (p - aim).sum()])
        h = p * (1 - p)
        hess = np.array([[h @ margins**2, h @ margins], [h @ margins, h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)
