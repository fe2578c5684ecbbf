"""Logistic fits side by side: settings, folds and groups are columns of the same matrices.

A fit takes the rows of some members (a fold or group number of each row), weighs the classes, scales
the features and has a strength and a penalty of its own; one pass serves all fits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.operators.newton import Solved, solve
from turnstone.operators.passes import Blocks

#: Share of the lasso in each penalty.
PENALTIES = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.5}


@dataclass(frozen=True)
class Fit:
    """One fit: inverse strength ``c`` of the penalty on the summed loss, its kind, members, class weights, scales (0 leaves a feature out)."""

    members: tuple[int, ...]
    c: float = 1.0
    penalty: str = "l2"
    class_weight: str | None = None
    scales: tuple[float, ...] = field(default=())


class Fits:
    """Settings of all fits as matrices."""

    def __init__(self, fits: Sequence[Fit], features: int, members: int, counts: np.ndarray):
        """``counts``: rows of each member and class."""
        self.size = features
        self.takes = np.zeros((members, len(fits)))
        self.classes = np.ones((2, len(fits)))
        self.scales = np.ones((len(fits), features))
        share = np.array([PENALTIES[f.penalty] for f in fits])
        self.strength = np.array([f.c for f in fits])
        for i, one in enumerate(fits):
            self.takes[list(one.members), i] = 1.0
            if one.scales:
                self.scales[i] = one.scales
            if one.class_weight == "balanced":
                own = counts[list(one.members)].sum(0)
                self.classes[:, i] = np.where(own > 0, own.sum() / (2 * np.maximum(own, 1)), 0.0)
        bare = np.concatenate([np.ones((len(fits), features)), np.zeros((len(fits), 1))], axis=1)  # the intercept is not penalised
        self.ridge, self.lasso = bare * (1 - share)[:, None], bare * share[:, None]
        self.free = np.concatenate([self.scales != 0, np.ones((len(fits), 1), dtype=bool)], axis=1)


def _margins(block: np.ndarray, fits: Fits, parameters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Member numbers, labels, features and the margin of each row in each fit."""
    member, y, x = block[:, 0].astype(int), block[:, 1], block[:, 2:]
    return member, y, x, x @ (parameters[:, :-1] * fits.scales).T + parameters[:, -1]


def _sums(block: np.ndarray, state: tuple[Fits, np.ndarray]) -> np.ndarray:
    """Loss, gradient and Hessian of each fit over a block."""
    fits, parameters = state
    member, y, x, z = _margins(block, fits, parameters)
    weight = fits.takes[member] * fits.classes[(y > 0).astype(int)]
    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    loss = (weight * (np.logaddexp(0, z) - y[:, None] * z)).sum(0)
    full = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    scale = np.concatenate([fits.scales, np.ones((len(fits.scales), 1))], axis=1)
    gradient = ((weight * (p - y[:, None])).T @ full) * scale
    size = full.shape[1]
    both = (full[:, :, None] * full[:, None, :]).reshape(len(full), -1)
    hessian = ((weight * p * (1 - p)).T @ both).reshape(-1, size, size) * scale[:, :, None] * scale[:, None, :]
    return np.concatenate([loss[:, None], gradient, hessian.reshape(len(loss), -1)], axis=1)


def _hits(block: np.ndarray, state: tuple[Fits, np.ndarray]) -> np.ndarray:
    """Rows and rightly classed rows of each member in each fit."""
    fits, parameters = state
    member, y, _, z = _margins(block, fits, parameters)
    right = ((z > 0) == (y[:, None] > 0)).astype(np.float64)
    out = np.zeros((fits.takes.shape[0], right.shape[1], 2))
    for m in np.unique(member):
        out[m, :, 0], out[m, :, 1] = (member == m).sum(), right[member == m].sum(0)
    return out


class Trainer:
    """Blocks of member, label and standardised features; fits them in groups of passes."""

    def __init__(self, rows: DataFrame, features: Sequence[str], label: str, member: Column, members: int):
        kept = rows.select(member.cast("int").alias("_m"), F.col(label).cast("double").alias("_y"), *features).where("_y IS NOT NULL AND _m IS NOT NULL")
        self.blocks, self.size, self.members = Blocks(kept, ["_m", "_y", *features]), len(features), members

    def __enter__(self) -> Trainer:
        self.blocks.__enter__()
        self.counts = self.blocks.total(self._count, self.members, (self.members, 2))
        return self

    def __exit__(self, *error) -> None:
        self.blocks.__exit__(*error)

    @staticmethod
    def _count(block: np.ndarray, members: int) -> np.ndarray:
        place = block[:, 0].astype(int) * 2 + (block[:, 1] > 0)
        return np.bincount(place, minlength=2 * members).reshape(members, 2).astype(np.float64)

    def fit(self, fits: Sequence[Fit], start: np.ndarray | None = None, passes: int = 30) -> tuple[Solved, Fits]:
        """Parameters of each fit: one for each (scaled) feature, then the intercept."""
        own = Fits(fits, self.size, self.members, self.counts)
        size = self.size + 1
        start = np.zeros((len(fits), size)) if start is None else np.where(own.free, start, 0.0)
        evaluate = lambda p: self.blocks.total(_sums, (own, p), (len(fits), 1 + size + size * size))
        return solve(evaluate, start, own.strength, own.ridge, own.lasso, passes, free=own.free), own

    def accuracy(self, found: Solved, fits: Fits, of: Sequence[int]) -> np.ndarray:
        """Share of rightly classed rows of the given member for each fit; 0 without rows."""
        hits = self.blocks.total(_hits, (fits, found.parameters), (self.members, len(of), 2))[list(of), np.arange(len(of))]
        return hits[:, 1] / np.maximum(hits[:, 0], 1)


def probability(features: Sequence[str], parameters: np.ndarray, scales: Sequence[float] = ()) -> Column:
    """The fitted probability of standardised features; a null feature counts as 0, the mean."""
    scales = list(scales) or [1.0] * len(features)
    margin = sum((F.coalesce(F.col(f), F.lit(0.0)) * F.lit(float(b * s)) for f, b, s in zip(features, parameters, scales)), F.lit(float(parameters[-1])))
    return 1 / (1 + F.exp(-margin))
