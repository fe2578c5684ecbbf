"""Logistic regression over hashed features, fitted in numpy on a bounded sample."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_sparse(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, penalty: float, steps: int, rate: float,
    balanced: bool = True,
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam; each row is (feature numbers, values).  Deterministic.

    ``balanced`` lets both classes weigh alike.  Without rows of both classes all weights are zero and the
    bias is the log odds of the only class, with one pseudo row of each.
    """
    labels = labels.astype(np.float64)
    good = labels.sum()
    prior = float(np.log((good + 1) / (len(labels) - good + 1)))
    weights = np.zeros(size)
    if not 0 < good < len(labels):
        return weights, prior
    counts = np.fromiter((len(i) for i, _ in rows), dtype=np.int64, count=len(rows))
    index = np.concatenate([i for i, _ in rows]).astype(np.int64)
    value = np.concatenate([v for _, v in rows]).astype(np.float64)
    row_of = np.repeat(np.arange(len(rows)), counts)
    share = np.where(labels > 0, 0.5 / good, 0.5 / (len(labels) - good)) if balanced else np.full(len(labels), 1 / len(labels))
    bias, m, v, mb, vb = 0.0, np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        z = np.bincount(row_of, weights[index] * value, len(rows)) + bias
        error = share * (sigmoid(z) - labels)
        slope = np.bincount(index, error[row_of] * value, size) + penalty * weights
        slope_b = error.sum()
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        mb, vb = 0.9 * mb + 0.1 * slope_b, 0.99 * vb + 0.01 * slope_b**2
        fix, fix2 = 1 - 0.9**step, 1 - 0.99**step
        weights -= rate * (m / fix) / (np.sqrt(v / fix2) + 1e-10)
        bias -= rate * (mb / fix) / (np.sqrt(vb / fix2) + 1e-10)
    return weights, float(bias)


def calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities (Platt's smoothed targets, Newton steps)."""
    good = labels.sum()
    bad = len(labels) - good
    if not 0 < good < len(labels):
        return 1.0, 0.0
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * scores + offset)
        w = np.maximum(p * (1 - p), 1e-9)
        e = p - target
        g = np.array([(e * scores).sum() + 1e-3 * (slope - 1), e.sum()])
        h = np.array([[(w * scores * scores).sum() + 1e-3, (w * scores).sum()], [(w * scores).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)
