"""A small network for regression, trained data-parallel: every task back-propagates its blocks, the gradients are added up.

One pass gives loss and gradient over all rows, so the result does not depend on partitions beyond the
rounding of sums.  Steps are quasi-Newton (limited memory) with backtracking.  A tenth of
the rows, chosen by their values, judges when to stop.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.operators.passes import Blocks

SEED = 1993
PASSES = 120
PATIENCE = 12
MEMORY = 10


def shapes(features: int, hidden: Sequence[int]) -> list[tuple[int, int]]:
    sizes = [features, *hidden, 1]
    return list(zip(sizes[:-1], sizes[1:]))


def start(features: int, hidden: Sequence[int], seed: int = SEED) -> np.ndarray:
    """Random weights fit for rectified units, no offsets."""
    draw = np.random.default_rng(seed)
    return np.concatenate([x for a, b in shapes(features, hidden) for x in (draw.normal(scale=np.sqrt(2 / a), size=a * b), np.zeros(b))])


def _layers(parameters: np.ndarray, features: int, hidden: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in shapes(features, hidden):
        out.append((parameters[at : at + a * b].reshape(a, b), parameters[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def forward(parameters: np.ndarray, x: np.ndarray, hidden: Sequence[int]) -> np.ndarray:
    """The network's value of each row."""
    layers = _layers(parameters, x.shape[1], hidden)
    for weight, offset in layers[:-1]:
        x = np.maximum(x @ weight + offset, 0.0)
    return (x @ layers[-1][0] + layers[-1][1])[:, 0]


def loss_and_gradient(parameters: np.ndarray, x: np.ndarray, y: np.ndarray, hidden: Sequence[int]) -> tuple[float, np.ndarray]:
    """Half the sum of squared errors and its gradient."""
    layers, seen = _layers(parameters, x.shape[1], hidden), [x]
    for weight, offset in layers[:-1]:
        seen.append(np.maximum(seen[-1] @ weight + offset, 0.0))
    error = (seen[-1] @ layers[-1][0] + layers[-1][1])[:, 0] - y
    back, parts = error[:, None], []
    for (weight, _), before in zip(reversed(layers), reversed(seen)):
        parts.append(np.concatenate([(before.T @ back).ravel(), back.sum(0)]))
        back = (back @ weight.T) * (before > 0)
    return float(error @ error) / 2, np.concatenate(parts[::-1])


def _sums(block: np.ndarray, state: tuple[np.ndarray, tuple[int, ...]]) -> np.ndarray:
    """Training rows, their loss, judged rows, their loss, gradient."""
    parameters, hidden = state
    judged, y, x = block[:, 0] > 0, block[:, 1], block[:, 2:]
    loss, gradient = loss_and_gradient(parameters, x[~judged], y[~judged], hidden)
    miss = forward(parameters, x[judged], hidden) - y[judged]
    return np.concatenate([[(~judged).sum(), loss, judged.sum(), float(miss @ miss) / 2], gradient])


@dataclass(frozen=True)
class Network:
    """Parameters, hidden sizes, scaling of features and target, mean judged loss after each taken step, passes."""

    parameters: np.ndarray
    hidden: tuple[int, ...]
    low: np.ndarray
    width: np.ndarray
    target_mean: float
    target_width: float
    judged: tuple[float, ...]
    passes: int


def fit(train: DataFrame, features: Sequence[str], target: str, hidden: Sequence[int], alpha: float = 1e-3, scale: str = "standard", passes: int = PASSES, seed: int = SEED) -> Network:
    """A network of rectified hidden layers.

    ``scale``: ``standard`` (mean 0, deviation 1) or ``range`` (0 to 1) of the training rows.  A null feature
    counts as the training mean; rows without a target take no part.
    """
    hidden, rows = tuple(hidden), train.where(F.col(target).isNotNull())
    stats = rows.agg(F.struct(
        *[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)], *[F.stddev_pop(f).alias(f"d{i}") for i, f in enumerate(features)],
        *[F.min(f).cast("double").alias(f"l{i}") for i, f in enumerate(features)], *[F.max(f).cast("double").alias(f"h{i}") for i, f in enumerate(features)],
        F.avg(target).alias("ym"), F.stddev_pop(target).alias("yd"))).first()[0]
    each = range(len(features))
    means = np.array([stats[f"m{i}"] or 0.0 for i in each])
    if scale == "range":
        low = np.array([stats[f"l{i}"] or 0.0 for i in each])
        width = np.array([(stats[f"h{i}"] or 0.0) - (stats[f"l{i}"] or 0.0) or 1.0 for i in each])
    else:
        low, width = means, np.array([stats[f"d{i}"] or 1.0 for i in each])
    middle, spread = float(stats["ym"] or 0.0), float(stats["yd"] or 1.0)
    judged = (F.pmod(F.xxhash64(F.lit(SEED), target, *features), F.lit(10)) == 0).cast("int").alias("_judged")
    scaled = rows.select(judged, ((F.col(target) - middle) / spread).alias("_y"), *[
        ((F.coalesce(F.col(f).cast("double"), F.lit(float(m))) - float(a)) / float(b)).alias(f"_f{i}") for i, (f, m, a, b) in enumerate(zip(features, means, low, width))])
    now = start(len(features), hidden, seed)
    with Blocks(scaled, ["_judged", "_y", *[f"_f{i}" for i in each]]) as data:
        now, judged, taken = _descend(lambda p: data.total(_sums, (p, hidden), (4 + len(now),)), now, alpha, passes)
    return Network(now, hidden, low, width, middle, spread, tuple(judged), taken)


def _descend(evaluate, now: np.ndarray, alpha: float, passes: int) -> tuple[np.ndarray, list[float], int]:
    """Limited-memory quasi-Newton steps; the parameters with the least judged loss."""

    def value(parameters: np.ndarray) -> tuple[float, np.ndarray, float]:
        sums = evaluate(parameters)
        n = max(sums[0], 1.0)
        loss = sums[1] / n + alpha / 2 * float(parameters @ parameters) / n
        return loss, (sums[4:] + alpha * parameters) / n, sums[3] / sums[2] if sums[2] else sums[1] / n

    loss, gradient, seen = value(now)
    best, kept, judged, taken, history = seen, now, [seen], 1, []
    since = 0
    while taken < passes and since < PATIENCE and np.abs(gradient).max() > 1e-6:
        q, weights = gradient.copy(), []
        for s, y, r in reversed(history):
            weights.append(r * (s @ q))
            q -= weights[-1] * y
        q *= (history[-1][0] @ history[-1][1]) / (history[-1][1] @ history[-1][1]) if history else min(1.0, 1 / np.abs(gradient).sum())
        for (s, y, r), a in zip(history, reversed(weights)):
            q += (a - r * (y @ q)) * s
        step, slope = 1.0, -float(gradient @ q)
        while taken < passes:
            trial = now - step * q
            found = value(trial)
            taken += 1
            if found[0] <= loss + 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        move, change = trial - now, found[1] - gradient
        if move @ change > 1e-12:
            history = [*history, (move, change, 1 / float(move @ change))][-MEMORY:]
        now, (loss, gradient, seen) = trial, found
        judged.append(seen)
        since = 0 if seen < best - 1e-4 * best else since + 1
        if seen < best:
            best, kept = seen, now
    return kept, judged, taken


def predict(model: Network, rows: DataFrame, features: Sequence[str], name: str = "predicted") -> DataFrame:
    """Rows with the network's value; a null feature counts as 0 after standardising, as the lowest value under ``range``."""
    if name in rows.columns:
        raise ValueError(f"rows already have a column {name}")
    shared = rows.sparkSession.sparkContext.broadcast(model)  # as large as the parameters
    names, fields = rows.columns, [f"_f{i}" for i in range(len(features))]
    scaled = rows.select("*", *[
        F.coalesce((F.col(f).cast("double") - float(a)) / float(b), F.lit(0.0)).alias(x) for f, x, a, b in zip(features, fields, model.low, model.width)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x = np.stack([batch.column(f).to_numpy() for f in fields], axis=1)
            value = forward(own.parameters, x, own.hidden) * own.target_width + own.target_mean
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(value)], [*names, name])

    return scaled.mapInArrow(run, rows.schema.add(name, "double"))
