"""Ordered running values that never need a whole key in one task.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task, so one
key holding a third of the table holds a third of the work.  Here the ordered
axis is cut into buckets (borders of a quantile sketch, or a month): rows are windowed within
(key, bucket), each bucket is reduced to one row, and the running value of the
buckets before is joined on.  Only bucket totals, never raw rows, are windowed
per key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"
#: Rows of a bucket, and buckets of a table at most; beyond, buckets grow with the table.
ROWS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 4096


class Buckets:
    """Borders of a number's range that cut a table into about equally many rows.

    They come from a mergeable quantile sketch of one pass, so neither an outlier nor a dense spot
    unbalances them; only rows of one value stay together.  A bucket is a non-decreasing function of the
    value, also of values beyond those seen; null values are a bucket of their own.
    """

    def __init__(self, df: DataFrame, value: Column, rows: int = ROWS_PER_BUCKET):
        self.value, self.borders = value.cast("double"), []
        count = df.count()
        if count > rows:
            number = min(MOST_BUCKETS, -(-count // rows))
            shares = [F.lit(i / number) for i in range(1, number)]
            found = df.agg(F.percentile_approx(self.value, F.array(*shares), max(10_000, 8 * number)).alias("q")).first()["q"]
            self.borders = sorted({q for q in found or [] if q == q})

    def of(self, df: DataFrame, name: str = BUCKET, value: Column | None = None) -> DataFrame:
        """Rows with the bucket of their value, or of another number on the same axis."""
        value = self.value if value is None else value.cast("double")
        if not self.borders:
            return df.withColumn(name, F.when(value.isNotNull(), 0))
        splits = [-math.inf, *self.borders, math.inf]
        placed = Bucketizer(splits=splits, inputCol="_axis", outputCol="_axis_cell", handleInvalid="keep").transform(df.withColumn("_axis", value))
        return placed.withColumn(name, F.when(F.col("_axis").isNotNull(), F.col("_axis_cell").cast("int"))).drop("_axis", "_axis_cell")


def even_buckets(df: DataFrame, value: Column, rows: int = ROWS_PER_BUCKET) -> Buckets:
    """Buckets of a number with about ``rows`` rows of ``df`` each."""
    return Buckets(df, value, rows)


def with_bucket(df: DataFrame, bucket: Column | Buckets, name: str = BUCKET) -> DataFrame:
    """Rows with their bucket: a column, or borders found in the data."""
    return bucket.of(df, name) if isinstance(bucket, Buckets) else df.withColumn(name, bucket)


def seconds(time: Column | str) -> Column:
    """Seconds of a time without a zone since 1970, rounded down: non-decreasing also where a zone has gaps."""
    return F.unix_date(F.to_date(time)) * F.lit(86400).cast("long") + F.hour(time) * 3600 + F.minute(time) * 60 + F.floor(F.second(time))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join by name in which a null key meets a null key; the left side's keys stay."""
    other = right.select(*[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in keys]
    return left.join(other, on, how).drop(*[f"_right_{c}" for c in keys])


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    bucket: Column | Buckets,
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    exclusive: bool = False,
) -> DataFrame:
    """Add running sums and running maxima per key.

    ``bucket`` must be a non-decreasing function of the order columns.  Rows whose
    key is null form a group of their own.  ``exclusive`` leaves the current row out.  A running sum
    of ``lit(1)`` is a row number; a running max of ``struct(order, payload)``
    where the payload exists carries the last known payload forward.
    """
    sums, maxes = dict(sums or {}), dict(maxes or {})
    keys = list(keys)
    rows = with_bucket(df, bucket)
    for name, value in {**sums, **maxes}.items():
        rows = rows.withColumn(f"_v_{name}", value)

    end = -1 if exclusive else Window.currentRow
    here = Window.partitionBy(*keys, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    # With no key at all the window runs over bucket totals only: one row per bucket.
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)

    totals = rows.groupBy(*keys, BUCKET).agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums],
        *[F.max(f"_v_{n}").alias(f"_t_{n}") for n in maxes],
    )
    carried = totals.select(
        *keys,
        BUCKET,
        *[F.sum(f"_t_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.max(f"_t_{n}").over(before).alias(f"_c_{n}") for n in maxes],
    )
    local = rows
    for n in sums:
        local = local.withColumn(f"_l_{n}", F.sum(f"_v_{n}").over(here))
    for n in maxes:
        local = local.withColumn(f"_l_{n}", F.max(f"_v_{n}").over(here))

    out = null_safe_join(local, carried, [*keys, BUCKET], "left")
    kept = [c for c in df.columns if c not in sums and c not in maxes]
    zero = F.lit(0)
    return out.select(
        *kept,
        *[
            F.when(
                F.col(f"_l_{n}").isNotNull() | F.col(f"_c_{n}").isNotNull(),
                F.coalesce(f"_l_{n}", zero) + F.coalesce(f"_c_{n}", zero),
            ).alias(n)
            for n in sums
        ],
        *[F.greatest(F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) if not _is_struct(local, f"_l_{n}")
          else F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in maxes],
    )


def _is_struct(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "struct"


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], bucket: Column | Buckets, name: str = "row_number"
) -> DataFrame:
    """1, 2, 3, ... per key in the given (total) order."""
    return prefix_scan(df, keys, order, bucket, sums={name: F.lit(1).cast("long")})


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | Buckets, value: str, name: str
) -> DataFrame:
    """The value on the row before (null on the first row of a key)."""
    packed = F.struct(*[F.col(c) for c in order], F.col(value).alias("_value"))
    out = prefix_scan(df, keys, order, bucket, maxes={"_prev": packed}, exclusive=True)
    return out.withColumn(name, F.col("_prev._value")).drop("_prev")


# --- ranks and exact quantiles over counted values -----------------------------
def counted_values(df: DataFrame, keys: Sequence[str], value: str, bucket: Column | Buckets) -> DataFrame:
    """Distinct values with their count ``n`` and the running count ``upto``.

    Copies collapse in the map-side aggregation, so repeated values cost one row.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return prefix_scan(counts, keys, [value], bucket, sums={"upto": F.col("n")})


def rank_by_value(
    df: DataFrame, keys: Sequence[str], value: str, bucket: Column | Buckets, method: str = "max",
    descending: bool = False, name: str = "rank",
) -> DataFrame:
    """Rank of each row's value within its keys; ties share ``max``, ``min`` or ``average`` rank."""
    keys = list(keys)
    counts = counted_values(df, keys, value, bucket)
    top = F.col("upto")
    if descending:
        totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
        counts = null_safe_join(counts, totals, keys)
        top = F.col("_total") - F.col("upto") + F.col("n")
    rank = {"max": top, "min": top - F.col("n") + 1, "average": top - (F.col("n") - 1) / 2.0}[method]
    ranks = counts.select(*keys, value, rank.alias(name))
    return null_safe_join(df, ranks, [*keys, value], "left")


def values_at_ranks(
    df: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Callable[[Column], Column]], bucket: Column | Buckets
) -> DataFrame:
    """The values at given 0-based ranks per key, one column per rank, and the row count ``_total``.

    A histogram of value buckets finds the bucket each rank falls into; only the
    rows of those buckets are then counted by value.  ``ranks`` maps a name to a
    function of the row count.
    """
    keys = list(keys)
    rows = with_bucket(df.where(F.col(value).isNotNull()), bucket).select(*keys, value, BUCKET)
    histogram = rows.groupBy(*keys, BUCKET).agg(F.count("*").alias("_n"))
    of_key = Window.partitionBy(*(keys or [F.lit(0)]))
    placed = histogram.withColumns({
        "_before": F.coalesce(
            F.sum("_n").over(of_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_total": F.sum("_n").over(of_key),
    })
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), rank(F.col("_total")).cast("long").alias("rank")) for name, rank in ranks.items()])
    targets = placed.withColumn("_w", F.explode(wanted)).where(
        (F.col("_w.rank") >= F.col("_before")) & (F.col("_w.rank") < F.col("_before") + F.col("_n"))
    ).select(*keys, BUCKET, "_before", "_total", F.col("_w.name").alias("_name"), F.col("_w.rank").alias("_rank"))
    near = null_safe_join(rows, targets.select(*keys, BUCKET).distinct(), [*keys, BUCKET]).groupBy(*keys, BUCKET, value).agg(F.count("*").alias("_n"))
    inside = Window.partitionBy(*keys, BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = near.withColumn("_upto", F.sum("_n").over(inside))
    hits = null_safe_join(targets, counted, [*keys, BUCKET]).where(F.col("_before") + F.col("_upto") > F.col("_rank"))
    return hits.groupBy(*keys).agg(
        *[F.min(F.when(F.col("_name") == name, F.col(value))).alias(name) for name in ranks], F.max("_total").alias("_total"))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], bucket: Column | Buckets,
    interpolation: str = "linear",
) -> DataFrame:
    """Exact quantiles per key: the values at the two ranks around each position.

    ``interpolation`` is ``linear``, ``midpoint``, ``lower`` or ``higher``.
    """
    ranks: dict[str, Callable[[Column], Column]] = {}
    for name, q in quantiles.items():
        ranks[f"_lo_{name}"] = lambda n, q=q: F.floor(F.lit(float(q)) * (n - 1))
        ranks[f"_hi_{name}"] = lambda n, q=q: F.ceil(F.lit(float(q)) * (n - 1))
    ends = values_at_ranks(df, keys, value, ranks, bucket)

    def between(name: str, q: float) -> Column:
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        at = F.lit(float(q)) * (F.col("_total") - 1)
        return {
            "linear": lo + (hi - lo) * (at - F.floor(at)),
            "midpoint": (lo + hi) / 2.0,
            "lower": lo,
            "higher": hi,
        }[interpolation]

    return ends.select(*keys, *[between(n, q).alias(n) for n, q in quantiles.items()])
