"""KMeans from many starts at once, for one or more groups of rows.

All starts of all groups share each pass: a block's distances to the centres of every start
are one matrix product.  Starts are drawn by squared distance (k-means++) with draws that depend on
a row's values, the start and the step.  The start with the least inertia wins.  Equal
rows are one row with a weight.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.operators.passes import Blocks, row_keys, scrambled

STARTS = 100
PASSES = 300
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Fitted:
    """Centres (k x d) and inertia of the best start of each group; inertia of all starts; passes taken."""

    centres: dict[str, np.ndarray]
    inertia: dict[str, float]
    of_starts: np.ndarray
    passes: int


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows x starts x centres."""
    flat = centres.reshape(-1, centres.shape[-1])
    apart = (x * x).sum(1)[:, None] - 2 * x @ flat.T + (flat * flat).sum(1)[None]
    return np.maximum(apart, 0.0).reshape(len(x), *centres.shape[:-1])


def _draw(block: np.ndarray, state: tuple) -> np.ndarray:
    """For each group and start the row with the least exponential draw at the rate of its weight and squared distance."""
    groups, starts, step, seed, centres = state
    out = np.full((groups, starts, 1 + block.shape[1] - 2), np.inf)
    for g in np.unique(block[:, 0]).astype(int):
        own = block[block[:, 0] == g]
        x, rate = own[:, 2:], np.repeat(own[:, 1:2], starts, axis=1)
        if step:
            rate = rate * squares(x, centres[g, :, :step]).min(2)
        key = row_keys(x)
        u = (np.stack([scrambled(key, seed, s, step) for s in range(starts)], axis=1) >> np.uint64(11)).astype(np.float64)
        with np.errstate(divide="ignore"):
            wait = np.where(rate > 0, -np.log((u + 0.5) / (1 << 53)) / rate, np.inf)
        first = wait.argmin(0)
        out[g, :, 0], out[g, :, 1:] = wait[first, np.arange(starts)], x[first]
    return out


def _sooner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two draws the earlier, by value among equals."""
    later = b[..., 0] < a[..., 0]
    return np.where(later[..., None], b, a)


def _sums(block: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Sums, weights and inertia of the rows nearest to each centre."""
    groups, starts, k, d = centres.shape
    out = np.zeros((groups, starts, k, d + 2))
    for g in np.unique(block[:, 0]).astype(int):
        own = block[block[:, 0] == g]
        x, weight = own[:, 2:], own[:, 1]
        apart = squares(x, centres[g])
        near = apart.argmin(2)
        place = (near + np.arange(starts) * k).ravel()
        add = lambda values: np.bincount(place, weights=values.ravel(), minlength=starts * k).reshape(starts, k)
        for j in range(d):
            out[g, :, :, j] = add(np.repeat((weight * x[:, j])[:, None], starts, axis=1))
        out[g, :, :, d] = add(np.repeat(weight[:, None], starts, axis=1))
        out[g, :, :, d + 1] = add(weight[:, None] * np.take_along_axis(apart, near[:, :, None], 2)[:, :, 0])
    return out


def fit(rows: DataFrame, features: Sequence[str], k: int, group: str | None = None, groups: Sequence[str] = ("",), starts: int = STARTS, seed: int = 0) -> Fitted:
    """Centres of ``k`` clusters of each group.  A null feature counts as 0; rows of unlisted groups take no part."""
    names = F.array(*[F.lit(g) for g in groups])
    code = F.array_position(names, F.col(group)) - 1 if group else F.lit(0)
    filled = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_f{i}") for i, f in enumerate(features)]
    coded = rows.select(code.alias("_g"), *filled).where("_g >= 0")
    fields = [f"_f{i}" for i in range(len(features))]
    distinct = coded.groupBy("_g", *fields).agg(F.count("*").alias("_n"))
    with Blocks(distinct, ["_g", "_n", *fields]) as data:
        count, d = len(groups), len(features)
        centres = np.zeros((count, starts, k, d))
        for step in range(k):
            first = data.total(_draw, (count, starts, step, seed, centres), (count, starts, 1 + d), _sooner, np.inf)
            drawn = np.isfinite(first[..., 0])  # fewer distinct rows than centres: the first centre again
            centres[:, :, step] = np.where(drawn[..., None], np.where(drawn[..., None], first[..., 1:], 0.0), centres[:, :, 0])
        passes = k
        for _ in range(PASSES):
            sums = data.total(_sums, centres, (count, starts, k, d + 2))
            passes += 1
            weight = sums[..., d : d + 1]
            moved = np.where(weight > 0, sums[..., :d] / np.maximum(weight, 1e-300), centres)
            spread = sums[..., d + 1].sum(2) / np.maximum(sums[..., d].sum(2), 1.0) / d
            still = ((moved - centres) ** 2).sum((2, 3)) <= TOLERANCE * 1e-4 * np.maximum(spread, 1e-300)
            centres = moved
            if still.all():
                break
        inertia = data.total(_sums, centres, (count, starts, k, d + 2))[..., d + 1].sum(2)
    best = inertia.argmin(1)
    return Fitted({g: centres[i, best[i]] for i, g in enumerate(groups)}, {g: float(inertia[i, best[i]]) for i, g in enumerate(groups)}, inertia, passes + 1)


def nearest(features: Sequence[str], centres: np.ndarray) -> Column:
    """Number of the nearest centre, the first of equally near ones."""
    apart = [sum(((F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - F.lit(float(c))) ** 2 for f, c in zip(features, centre)), F.lit(0.0)) for centre in centres]
    return (F.array_position(F.array(*apart), F.least(*apart) if len(apart) > 1 else apart[0]) - 1).cast("int")


def place(rows: DataFrame, features: Sequence[str], fitted: Fitted, group: str | None = None, name: str = "cluster") -> DataFrame:
    """Rows with the number of their group's nearest centre; null for rows of other groups."""
    if not group:
        return rows.withColumn(name, nearest(features, fitted.centres[""]))
    chosen = F.coalesce(*[F.when(F.col(group) == g, nearest(features, c)) for g, c in fitted.centres.items()])
    return rows.withColumn(name, chosen)
