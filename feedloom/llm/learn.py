"""Small numeric helpers for models that are fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(
    x: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray | None = None,
    penalty: float = 1.0,
    steps: int = 30,
) -> np.ndarray:
    """Weights of a logistic model with a constant (last), by Newton steps.

    The constant is not penalised. Without two classes the constant alone gives the share of
    ones, with one observation of each class added.
    """
    out = np.zeros(x.shape[1] + 1)
    if len(np.unique(y)) < 2:
        out[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        return out
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.ones(len(x)) if weight is None else weight
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ out)
        gradient = x.T @ (weight * (p - y)) + ridge * out
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        step = np.linalg.solve(curve + np.diag(ridge), gradient)
        out -= step
        if np.abs(step).max() < 1e-6:
            break
    return out


def fit_svm(
    x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 60
) -> np.ndarray:
    """Weights of a linear support vector machine with a constant (last).

    ``y`` is 1 or -1; the loss is the squared hinge, minimised by Newton steps over the vectors
    inside the margin.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    out = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-3
    before = None
    for _ in range(steps):
        inside = y * (x @ out) < 1
        if before is not None and (inside == before).all():
            break
        before = inside
        a, b, c = x[inside], y[inside], cost[inside]
        curve = (a * c[:, None]).T @ a + np.diag(ridge)
        target = np.linalg.solve(curve, (a * c[:, None]).T @ b)
        out = target if before is None else out + 0.7 * (target - out)
    return out
