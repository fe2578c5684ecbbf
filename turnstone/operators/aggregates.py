"""Aggregation patterns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions.scalars import lookup, ratio


def weighted_mean(df: DataFrame, keys: Sequence[str], weight: str, values: Mapping[str, str]) -> DataFrame:
    """Sum of value times weight over the sum of all weights.

    A null value adds nothing above the line but its weight still counts below it.
    """
    return df.groupBy(*keys).agg(
        *[ratio(F.sum(F.col(v) * F.col(weight)), F.sum(weight)).alias(n) for n, v in values.items()]
    )


def season_weighted_mean(
    df: DataFrame, keys: Sequence[str], season: str, weights: Mapping[str, float], values: Mapping[str, str]
) -> DataFrame:
    """Weighted mean whose weight is kept per season."""
    return weighted_mean(df.withColumn("_w", lookup(season, weights)), keys, "_w", values)


def sum_where(value: Column | str, condition: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def wide_by(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[Any], aggs: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """One column per listed value and aggregate, in one pass and one shuffle.

    ``aggs`` maps a name prefix to (function, value column).
    """
    fns = {"sum": F.sum, "max": F.max, "count": F.count}
    out = []
    for v in values:
        for prefix, (fn, source) in aggs.items():
            tag = str(v).lower().replace("-", "").replace(" ", "_")
            out.append(fns[fn](F.when(F.col(column) == F.lit(v), F.col(source))).alias(f"{prefix}_{tag}"))
    return df.groupBy(*keys).agg(*out)


def with_total_rows(df: DataFrame, keys: Sequence[str], over: str, total: Any, aggs: Sequence[Column]) -> DataFrame:
    """Group rows plus one total row per ``keys``, as one grouping-sets pass."""
    grouped = df.groupingSets([[*keys, over], [*keys]], *keys, over).agg(*aggs, F.grouping(over).alias("_all"))
    return grouped.withColumn(
        over, F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col(over))
    ).drop("_all")


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and percent per column, from one aggregate row."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot(["n"], list(columns), "column_name", "missing").select(
        "column_name", "missing", (F.col("missing") * 100.0 / F.col("n")).alias("missing_percent")
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every two columns, long form, from one aggregate row."""
    pairs = [(a, b) for a in columns for b in columns]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    items = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs]
    )
    return one.select(F.explode(items).alias("p")).select("p.a", "p.b", "p.r")


def fill_with_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the column mean, read once as a scalar."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in columns})


def strongest_status(df: DataFrame, keys: Sequence[str], status: str, order: Sequence[str]) -> DataFrame:
    """One status per key: the one listed first in ``order``.  One aggregate, no anti joins."""
    rank = lookup(status, {s: i for i, s in enumerate(order)})
    best = df.groupBy(*keys).agg(F.min(rank).alias("_rank"))
    return best.select(*keys, lookup("_rank", dict(enumerate(order))).alias(status))


def consecutive_tenure(df: DataFrame, key: str, season_start: str, latest: int) -> DataFrame:
    """Length of the run of consecutive seasons that ends at ``latest`` (0 if absent).

    Seasons are made distinct first; the set per key is bounded by the calendar.
    """
    seasons = df.where(F.col(season_start) <= latest).select(key, season_start).distinct()
    held = seasons.groupBy(key).agg(F.collect_set(season_start).alias("_held"))
    back = F.sequence(F.lit(latest), F.array_min("_held"), F.lit(-1))
    gaps = F.filter(back, lambda s: ~F.array_contains(F.col("_held"), s))
    run = F.when(
        F.size(gaps) > 0, F.lit(latest) - F.array_max(gaps)
    ).otherwise(F.lit(latest) - F.array_min("_held") + 1)
    return held.select(key, run.cast("int").alias("tenure"))


def modal_value(df: DataFrame, key: str, value: str, tiebreak: Column) -> DataFrame:
    """Most frequent value per key; ties go to the smaller tiebreak, then the smaller value."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(
        F.min(F.struct((-F.col("n")).alias("a"), tiebreak.alias("b"), F.col(value).alias("v"))).alias("m")
    )
    return best.select(key, F.col("m.v").alias(value), (-F.col("m.a")).alias("n"))
