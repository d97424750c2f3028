"""A linear support vector machine on a bounded sample, by dual coordinate descent.

Defined results: an empty sample gives zero weights, a sample of one class a machine that always answers it. Repeated rows weigh
as often as they stand. Features must be finite numbers.
"""

from __future__ import annotations

import numpy as np


def fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray | float = 1.0, epochs: int = 20, seed: int = 5, bias: float | None = None) -> np.ndarray:
    """Weights, the last one the bias, that minimise hinge loss times ``cost`` plus half the squared weights.

    ``y`` holds 1 and -1. A ``bias`` that is given stays fixed. The result depends on the rows' order and the seed alone.
    """
    if bias is None:
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    fixed = bias or 0.0
    upper = np.broadcast_to(np.asarray(cost, np.float64), (len(x),))
    alpha, weights = np.zeros(len(x)), np.zeros(x.shape[1])
    square = np.einsum("ij,ij->i", x, x).astype(np.float64) + 1e-12
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(x)):
            gradient = y[i] * (x[i] @ weights + fixed) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return weights if bias is None else np.append(weights, fixed)


def fit_sigmoid(margins: np.ndarray, positive: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a * margin + b))) by Newton steps on smoothed targets."""
    n, p = int((~positive).sum()), int(positive.sum())
    target = np.where(positive, (p + 1) / (p + 2), 1 / (n + 2))
    a, b = 1.0, float(np.log((p + 1) / (n + 1)))
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        weight = np.maximum(guess * (1 - guess), 1e-9)
        error = guess - target
        gradient = np.array([(error * margins).sum() + 1e-3 * a, error.sum()])
        hessian = np.array([[(weight * margins * margins).sum() + 1e-3, (weight * margins).sum()], [(weight * margins).sum(), weight.sum() + 1e-9]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - float(np.clip(step[0], -5, 5)), b - float(np.clip(step[1], -5, 5))
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b
