"""Many convex fits side by side: one pass gives objective, gradient and Hessian of all of them.

Steps are damped: where an objective did not fall, the next pass tries half the step.  The number
of passes is that of the slowest fit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

HALVINGS = 30


@dataclass(frozen=True)
class Solved:
    """Parameters of each fit, how far each is from its first-order condition, and passes taken."""

    parameters: np.ndarray
    gap: np.ndarray
    passes: int


def unpack(sums: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of each fit from rows of 1 + size + size * size sums."""
    return sums[:, 0], sums[:, 1 : 1 + size], sums[:, 1 + size :].reshape(-1, size, size)


def solve(
    evaluate: Callable[[np.ndarray], np.ndarray], start: np.ndarray, strength: np.ndarray, ridge: np.ndarray, lasso: np.ndarray,
    passes: int = 30, tolerance: float = 1e-6, free: np.ndarray | None = None,
) -> Solved:
    """Minimise ``strength * loss + ridge / 2 * p**2 + lasso * |p|`` for each row of parameters.

    ``evaluate`` gives the sums of ``unpack`` at given parameters by one pass.  ``ridge`` and
    ``lasso`` have a value for each parameter; ``free`` says which parameters may move.
    """
    now, size = start.copy(), start.shape[1]
    free = np.ones(start.shape, dtype=bool) if free is None else free
    best = np.full(len(start), np.inf)
    trial, step, taken = now.copy(), np.zeros_like(now), 0
    gradient, hessian, gap = np.zeros_like(now), np.zeros((len(now), size, size)), np.full(len(now), np.inf)
    halved = np.zeros(len(now), dtype=int)
    while taken < passes:
        loss, slope, bend = unpack(evaluate(trial), size)
        taken += 1
        value = strength * loss + (ridge * trial**2 / 2 + lasso * np.abs(trial)).sum(1)
        better = value <= best + 1e-12 * np.abs(best).clip(max=1e300)
        now[better], best[better], halved[better] = trial[better], value[better], 0
        halved[~better] += 1
        gradient[better], hessian[better] = (strength[:, None] * slope)[better], (strength[:, None, None] * bend)[better]
        pull = gradient + ridge * now
        off = np.where(now != 0, np.abs(pull + lasso * np.sign(now)), np.maximum(np.abs(pull) - lasso, 0.0))
        gap = np.where(free, off, 0.0).max(1) / np.maximum(1.0, strength)
        done = (gap <= tolerance) | (halved > HALVINGS)
        if done.all():
            break
        for i in np.flatnonzero(better & ~done):
            step[i] = _direction(now[i], gradient[i], hessian[i], ridge[i], lasso[i], free[i])
        trial = np.where(done[:, None], now, now + step * 0.5 ** halved[:, None])
    return Solved(now, gap, taken)


def _direction(now: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, ridge: np.ndarray, lasso: np.ndarray, free: np.ndarray) -> np.ndarray:
    """From the present parameters to the least point of the quadratic model with its penalties."""
    out = np.zeros_like(now)
    at = np.flatnonzero(free)
    model = hessian[np.ix_(at, at)] + np.diag(ridge[at] + 1e-10)
    pull = gradient[at] + ridge[at] * now[at]
    if not lasso[at].any():
        out[at] = -np.linalg.lstsq(model, pull, rcond=None)[0]
        return out
    out[at] = _lasso(model, pull, now[at], lasso[at])
    return out


def _lasso(model: np.ndarray, pull: np.ndarray, now: np.ndarray, lasso: np.ndarray, rounds: int = 60, sweeps: int = 12) -> np.ndarray:
    """The move that minimises ``pull . m + m . model . m / 2 + lasso . |now + m|``.

    Sweeps over the coordinates find which of them end at nothing and the signs of the others;
    then a linear system gives the rest, unless it contradicts those signs.
    """
    move = np.zeros(len(now))
    slope = pull.copy()  # of the quadratic part at the present move
    for _ in range(rounds):
        for _ in range(sweeps):
            for j in range(len(now)):
                wish = model[j, j] * (now[j] + move[j]) - slope[j]
                step = np.sign(wish) * max(abs(wish) - lasso[j], 0.0) / model[j, j] - now[j] - move[j]
                if step:
                    move[j] += step
                    slope += model[j] * step
        held = np.abs(now + move) > 0
        sign = np.sign(now + move)
        exact = -now.copy()
        fixed = pull[held] + lasso[held] * sign[held] + model[np.ix_(held, ~held)] @ exact[~held]
        exact[held] = -np.linalg.lstsq(model[np.ix_(held, held)], fixed, rcond=None)[0]
        rest = pull + model @ exact
        if (np.sign(now + exact)[held] == sign[held]).all() and (np.abs(rest[~held]) <= lasso[~held] * (1 + 1e-9) + 1e-12).all():
            return exact
    return move
