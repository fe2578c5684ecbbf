"""Kernel regression with an insensitive band, for many groups of rows in the same passes.

The Gaussian kernel becomes random Fourier features, the polynomial kernel its monomials; the loss
(nothing inside the band, linear outside) is rounded over a short stretch, so Newton
steps apply.  A pass adds up loss, gradient and Hessian of all groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.operators.newton import Solved, solve
from turnstone.operators.passes import Blocks

WAVES = 128
BAND = 0.1
#: Stretches over which the corner of the loss is rounded, from coarse to fine.
ROUNDINGS = (1.0, 0.2, 0.04, 0.01)
SEED = 1993


@dataclass(frozen=True)
class Kernel:
    """A map to features whose products are (about) the kernel."""

    kind: str
    gamma: float
    dims: int
    degree: int = 3
    waves: int = WAVES

    @property
    def size(self) -> int:
        return self.waves if self.kind == "rbf" else len(self._powers())

    def _powers(self) -> list[tuple[int, ...]]:
        return list(combinations_with_replacement(range(self.dims), self.degree))

    def features(self, x: np.ndarray) -> np.ndarray:
        if self.kind == "rbf":
            draw = np.random.default_rng([SEED, self.dims, self.waves])
            slope = draw.normal(scale=math.sqrt(2 * self.gamma), size=(self.dims, self.waves))
            return math.sqrt(2 / self.waves) * np.cos(x @ slope + draw.uniform(0, 2 * math.pi, self.waves))
        if self.kind != "poly":
            raise ValueError(f"unknown kernel {self.kind}")
        out = []
        for powers in self._powers():  # (gamma x.y)^degree is a sum over monomials with multinomial weights
            times = math.factorial(self.degree) / math.prod(math.factorial(powers.count(i)) for i in set(powers))
            out.append(math.sqrt(times * self.gamma**self.degree) * np.prod(x[:, list(powers)], axis=1))
        return np.stack(out, axis=1)


def _sums(block: np.ndarray, state: tuple[Kernel, np.ndarray, float, float]) -> np.ndarray:
    kernel, parameters, band, rounding = state
    size = parameters.shape[1]
    out = np.zeros((len(parameters), 1 + size + size * size))
    for g in np.unique(block[:, 0]).astype(int):
        own = block[block[:, 0] == g]
        full = np.concatenate([kernel.features(own[:, 2:]), np.ones((len(own), 1))], axis=1)
        miss = full @ parameters[g] - own[:, 1]
        over = np.abs(miss) - band
        bent = (over > 0) & (over < rounding)
        loss = np.where(bent, over**2 / (2 * rounding), np.maximum(over - rounding / 2, 0.0))
        slope = np.sign(miss) * np.clip(over / rounding, 0.0, 1.0)
        out[g, 0], out[g, 1 : 1 + size] = loss.sum(), slope @ full
        out[g, 1 + size :] = (full[bent].T @ full[bent] / rounding).ravel()
    return out


@dataclass(frozen=True)
class Regression:
    """Parameters of each group (the intercept last) and how well the fit ended."""

    kernel: Kernel
    groups: tuple[str, ...]
    solved: Solved


def fit(
    train: DataFrame, features: Sequence[str], target: str, group: str | None = None, groups: Sequence[str] = ("",), kind: str = "rbf",
    gamma: float | None = None, c: float = 1.0, band: float = BAND, passes: int = 60, waves: int = WAVES,
) -> Regression:
    """A regression of ``target`` for each listed group; rows without a target take no part, null features count as 0."""
    kernel = Kernel(kind, gamma if gamma is not None else 1 / len(features), len(features), waves=waves)
    code = F.array_position(F.array(*[F.lit(g) for g in groups]), F.col(group)) - 1 if group else F.lit(0)
    coded = train.select(code.alias("_g"), F.col(target).cast("double").alias("_y"), *features).where("_g >= 0 AND _y IS NOT NULL")
    size, count = kernel.size + 1, len(groups)
    with Blocks(coded, ["_g", "_y", *features]) as data:
        sums = data.total(_targets, count, (count, 2))
        start = np.zeros((count, size))
        start[:, -1] = sums[:, 1] / np.maximum(sums[:, 0], 1)
        ridge = np.concatenate([np.ones((count, size - 1)), np.zeros((count, 1))], axis=1)
        taken, solved = 0, None
        for rounding in ROUNDINGS:
            evaluate = lambda p, r=rounding: data.total(_sums, (kernel, p, band, r), (count, 1 + size + size * size))
            left = passes - taken
            solved = solve(evaluate, start, np.full(count, c), ridge, np.zeros((count, size)), left if rounding == ROUNDINGS[-1] else min(left, 8), 1e-5)
            start, taken = solved.parameters, taken + solved.passes
    return Regression(kernel, tuple(groups), Solved(solved.parameters, solved.gap, taken))


def _targets(block: np.ndarray, groups: int) -> np.ndarray:
    place = block[:, 0].astype(int)
    return np.stack([np.bincount(place, minlength=groups), np.bincount(place, weights=block[:, 1], minlength=groups)], axis=1).astype(np.float64)


def predict(model: Regression, rows: DataFrame, features: Sequence[str], group: str | None = None, name: str = "predicted") -> DataFrame:
    """Rows with the predicted target; null for rows of groups without a model."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # as large as the parameters
    names, fields = rows.columns, [f"_f{i}" for i in range(len(features))]
    code = F.array_position(F.array(*[F.lit(g) for g in model.groups]), F.col(group)) - 1 if group else F.lit(0)
    coded = rows.select("*", F.coalesce(code, F.lit(-1)).cast("int").alias("_g"), *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(x) for f, x in zip(features, fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            g = batch.column("_g").to_numpy()
            x = np.stack([batch.column(f).to_numpy() for f in fields], axis=1)
            full = np.concatenate([own.kernel.features(x), np.ones((len(x), 1))], axis=1)
            value = (full * own.solved.parameters[np.maximum(g, 0)]).sum(1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(value, mask=g < 0)], [*names, name])

    schema = rows.drop(name).schema.add(name, "double") if name not in names else None
    if schema is None:
        raise ValueError(f"rows already have a column {name}")
    return coded.mapInArrow(run, schema)
