"""Logistic regression on a bounded sample in memory (L2, Newton steps), and Platt scaling."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class LinearModel:
    """Standardised features times weights plus bias."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def fit(x: np.ndarray, y: np.ndarray, sample_weight: np.ndarray | None = None,
        l2: float = 1.0, rounds: int = 30) -> LinearModel:
    """Weighted logistic regression; ``y`` may hold probabilities. Without rows, or with no
    feature, the model is the weighted mean of the labels (0.5 without rows)."""
    n, d = x.shape
    w = np.ones(n) if sample_weight is None else np.asarray(sample_weight, float)
    if n == 0 or w.sum() <= 0:
        return LinearModel(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    mean = np.average(x, axis=0, weights=w)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=w))
    scale[scale < 1e-9] = 1.0
    z = np.hstack([(x - mean) / scale, np.ones((n, 1))])
    ridge = np.full(d + 1, l2)
    ridge[-1] = 1e-3
    beta = np.zeros(d + 1)
    share = np.clip(np.average(y, weights=w), 1e-3, 1 - 1e-3)
    beta[-1] = np.log(share / (1 - share))

    def loss(b):
        m = z @ b
        return float((w * (np.logaddexp(0, m) - y * m)).sum() + 0.5 * (ridge * b * b).sum())

    now = loss(beta)
    for _ in range(rounds):
        p = sigmoid(z @ beta)
        grad = z.T @ (w * (p - y)) + ridge * beta
        hess = (z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-4 and loss(beta - size * step) > now:
            size /= 2
        beta = beta - size * step
        then = loss(beta)
        if now - then < 1e-7 * (1 + abs(now)):
            break
        now = then
    return LinearModel(mean, scale, beta[:-1], float(beta[-1]))


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) with probability = sigmoid(a * margin + b), fitted on held-out rows; a >= 0."""
    if len(y) < 20 or y.min() == y.max():
        return 1.0, 0.0
    model = fit(margin[:, None], y, l2=1e-2)
    a = model.weights[0] / model.scale[0]
    b = model.bias - a * model.mean[0]
    return (float(a), float(b)) if a > 0 else (0.0, float(np.log(y.mean() / (1 - y.mean()))))
