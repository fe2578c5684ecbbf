"""Least squares per group from one aggregate pass.

Means and covariances are map-side combined, so a group of any size reaches the
solver as one row; only that small matrix is handed to numpy.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from turnstone.functions.scalars import clamp, log_or_zero


@F.pandas_udf(ArrayType(DoubleType()))
def _solve(xx: pd.Series, xy: pd.Series) -> pd.Series:
    def one(a, b):
        b = np.asarray(b, dtype=float)
        return np.linalg.lstsq(np.asarray(a, dtype=float).reshape(len(b), len(b)), b, rcond=None)[0].tolist()

    return pd.Series([one(a, b) for a, b in zip(xx, xy)])


def fit_least_squares(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: Column | str) -> DataFrame:
    """One row per group: feature means and deviations, target mean and slopes."""
    y = F.col(target) if isinstance(target, str) else target
    rows = df.select(*keys, *[F.col(f).cast("double").alias(f) for f in features], y.cast("double").alias("_y"))
    rows = rows.dropna(subset=[*features, "_y"])
    moments = rows.groupBy(*keys).agg(
        F.array(*[F.avg(f) for f in features]).alias("x_mean"),
        F.array(*[F.stddev_pop(f) for f in features]).alias("x_dev"),
        F.avg("_y").alias("y_mean"),
        F.array(*[F.covar_pop(a, b) for a in features for b in features]).alias("_xx"),
        F.array(*[F.covar_pop(f, "_y") for f in features]).alias("_xy"),
    )
    return moments.withColumn("slope", _solve("_xx", "_xy")).drop("_xx", "_xy")


def predict_least_squares(
    df: DataFrame, model: DataFrame, keys: Sequence[str], features: Sequence[str], name: str, scale: str = "train"
) -> DataFrame:
    """Predictions for new rows.

    ``scale="train"`` measures new rows with the training mean and deviation,
    ``scale="independent"`` standardises them by their own, per group, which is
    what a scaler fitted anew on the rows to predict does.
    """
    keys = list(keys)
    if keys:
        rows = df.join(model, keys, "left")  # a group without history keeps its rows, with a null prediction
    else:
        one = model.select(F.struct("*").alias("m")).scalar()
        rows = df.withColumns({c: one[c] for c in ("x_mean", "x_dev", "y_mean", "slope")})
    if scale == "independent":
        own = [F.avg(f).alias(f"_m_{f}") for f in features] + [F.stddev_pop(f).alias(f"_d_{f}") for f in features]
        stats = df.groupBy(*keys).agg(*own)
        if keys:
            rows = rows.join(stats, keys)
        else:
            s = stats.select(F.struct("*")).scalar()
            rows = rows.withColumns({f"_{k}_{f}": s[f"_{k}_{f}"] for k in "md" for f in features})

    def step(i: int, f: str) -> Column:
        x = F.col(f).cast("double")
        if scale == "independent":
            dev = F.when(F.col(f"_d_{f}") == 0, 1.0).otherwise(F.col(f"_d_{f}"))
            return F.col("slope")[i] * F.col("x_dev")[i] * (x - F.col(f"_m_{f}")) / dev
        return F.col("slope")[i] * (x - F.col("x_mean")[i])

    value = F.col("y_mean")
    for i, f in enumerate(features):
        value = value + step(i, f)
    return rows.select(*df.columns, value.alias(name))


def forecast_by_group(
    history: DataFrame, upcoming: DataFrame, keys: Sequence[str], features: Sequence[str], target: str,
    log_target: bool = False, capacity: str | None = None, whole: bool = False, scale: str = "train",
) -> DataFrame:
    """Fit on history per group, predict the upcoming rows, bound them to [0, capacity]."""
    y = log_or_zero(target) if log_target else F.col(target)
    model = fit_least_squares(history, keys, features, y)
    out = predict_least_squares(upcoming, model, keys, features, "predicted", scale)
    if log_target:
        out = out.withColumn("predicted", F.exp("predicted"))
    if capacity:
        out = out.withColumn("predicted", clamp("predicted", capacity))
    return out.withColumn("predicted", F.col("predicted").cast("int")) if whole else out
