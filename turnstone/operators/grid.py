"""Dense grids, filled series and booking curves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_grid(base: DataFrame, axes: Mapping[str, DataFrame | Sequence]) -> DataFrame:
    """Every row of ``base`` with every value of each axis.

    An axis is a short list (levels, hours, calendar days): a Python sequence or a
    one-column DataFrame whose distinct values are gathered once, map-side
    combined, as one array.  ``base`` stays distributed and is never shuffled:
    each row is exploded where it lies, so no product join is planned.
    """
    out = base
    for name, axis in axes.items():
        if isinstance(axis, DataFrame):
            values = axis.agg(F.sort_array(F.collect_set(F.col(axis.columns[0])))).scalar()
        else:
            values = F.array(*[F.lit(v) for v in axis])
        out = out.withColumn(name, F.explode(values))
    return out


def day_axis(df: DataFrame, day: str, name: str = "day") -> DataFrame:
    """All calendar days between the first and the last day of a table."""
    ends = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias(name))


def fill_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str | None = None
) -> DataFrame:
    """Last known value so far.  For grids: rows per key are bounded by the axis."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name or value, F.last(value, ignorenulls=True).over(w))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, name: str
) -> DataFrame:
    """Running sum over rows already reduced to one per key and step."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def booking_curve(
    facts: DataFrame, keys: Sequence[str], step: str, value: str, steps: Sequence[int] | DataFrame,
) -> DataFrame:
    """Cumulative ``value`` per key at every step, with its share of the final value.

    Facts are reduced to one row per key and step before anything is ordered, so
    the windows see at most ``len(steps)`` rows per key however many sales a key
    has.  Steps without a sale carry the curve; steps before the first sale are 0.
    """
    keys = list(keys)
    per_step = facts.groupBy(*keys, step).agg(F.sum(value).alias("sold"))
    curve = running_total(per_step, keys, [step], "sold", "cumulative")
    grid = dense_grid(facts.select(*keys).distinct(), {step: steps})
    filled = fill_forward(
        grid.join(curve, [*keys, step], "left"), keys, [step], "cumulative"
    ).withColumn("cumulative", F.coalesce("cumulative", F.lit(0.0)))
    whole = Window.partitionBy(*keys)
    final = F.max_by("cumulative", step).over(whole)
    return filled.select(
        *keys,
        step,
        F.coalesce("sold", F.lit(0.0)).alias("sold"),
        "cumulative",
        final.alias("final"),
        (F.col("cumulative") / F.nullif(final, F.lit(0.0))).alias("share_of_final"),
    )


def zero_fill_past(moment: str, value: str, as_of) -> Column:
    """Empty past steps are zero; empty future steps stay unknown."""
    return F.when(F.col(moment) <= F.lit(as_of), F.coalesce(F.col(value), F.lit(0))).otherwise(F.col(value))
