"""Windows over series that an earlier step bounded (days, seasons, games).

Each function names the bound it relies on.  Series of raw rows belong in
``scan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def streaks(attendance: DataFrame, client: str, day: str, attended: str) -> DataFrame:
    """Length of the current run of attended events, 0 on a missed one.

    Scans are reduced to one row per client and event day first, so a client has
    at most one row per event however often it was scanned.
    """
    per_day = attendance.groupBy(client, day).agg(F.max(F.col(attended).cast("int")).alias("attended"))
    w = Window.partitionBy(client).orderBy(day)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    breaks = F.sum(F.when(F.col("attended") == 0, 1).otherwise(0)).over(so_far)
    runs = per_day.withColumn("_run", breaks)
    in_run = Window.partitionBy(client, "_run").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    latest = attendance.agg(F.max(day)).scalar()
    return runs.select(
        client,
        day,
        "attended",
        F.sum("attended").over(in_run).alias("streak"),
        (F.col(day) == latest).alias("is_most_recent"),
    )


def day_density(events: DataFrame, keys: Sequence[str], day: str, reach: int = 3) -> DataFrame:
    """Distinct event days within ``reach`` days either side, days before and after.

    One row per key and calendar day; the range window runs over days, not events.
    """
    days = events.select(*keys, day).distinct().withColumn("_n", F.datediff(F.col(day), F.lit("1970-01-01")))
    near = Window.partitionBy(*keys).orderBy("_n").rangeBetween(-reach, reach)
    step = Window.partitionBy(*keys).orderBy("_n")
    return days.select(
        *keys,
        day,
        F.count("*").over(near).alias("density"),
        (F.col("_n") - F.lag("_n").over(step)).alias("days_before"),
        (F.lead("_n").over(step) - F.col("_n")).alias("days_after"),
    )


def within_year_density(events: DataFrame, keys: Sequence[str], day: str, reach: int = 3) -> DataFrame:
    """Density whose window wraps inside one calendar year.

    Around New Year the days past the year's end are looked up at its start and
    the other way round, always in the year of the event.  29 February is not
    part of the 365-day ring unless the year has it.
    """
    days = events.select(*keys, day).distinct().withColumns({
        "_year": F.year(day), "_pos": F.dayofyear(day),
        "_len": F.dayofyear(F.make_date(F.year(day), F.lit(12), F.lit(31))),
    })
    images = days.withColumn("_shift", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn(
        "_at", F.col("_pos") + F.col("_shift") * F.col("_len")
    )
    near = Window.partitionBy(*keys, "_year").orderBy("_at").rangeBetween(-reach, reach)
    return images.withColumn("density", F.count("*").over(near)).where("_shift = 0").select(
        *keys, day, "density"
    )


def back_to_back(events: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """2 after an event the day before, 1 before an event the day after, else 0."""
    near = day_density(events, keys, day)
    return near.select(
        *keys,
        day,
        F.when(F.col("days_before") == 1, 2).when(F.col("days_after") == 1, 1).otherwise(0).alias("back_to_back"),
    )


def expanding_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean so far per key; null on rows whose own value is null.  For one row per event."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.when(F.col(value).isNotNull(), F.avg(value).over(w)))


def trailing_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int, name: str) -> DataFrame:
    """Mean of the ``n`` rows before the current one.  For one row per event."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-n, -1)
    return df.withColumn(name, F.avg(value).over(w))


def change_from_previous(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Relative change to the row before, 0 on the first.  For one row per season."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({
        f"{v}_change": F.coalesce(F.col(v) / F.nullif(F.lag(v).over(w), F.lit(0.0)) - 1, F.lit(0.0)) for v in values
    })


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Value over the group's sum, by an aggregate joined back (no window over the group)."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    return df.join(totals, list(keys)).withColumn(
        name, F.col(value) / F.nullif(F.col("_total").cast("double"), F.lit(0.0))
    ).drop("_total")


def percent_of_final(df: DataFrame, keys: Sequence[str], days_out: str, value: str) -> DataFrame:
    """Cumulative value from far to near, its share of the final one and what is left.

    One row per key and day out.  The final value is the cumulative one at the
    smallest day out.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(days_out).desc())
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    curve = df.withColumn("cumulative", F.sum(value).over(so_far))
    final = F.min_by("cumulative", days_out).over(whole)
    return curve.withColumn("final", final).withColumns({
        "share_in": F.col("cumulative") / F.nullif(F.col("final").cast("double"), F.lit(0.0)),
        "left": F.col("final") - F.col("cumulative") + F.col(value),
    })


def flag_latest(df: DataFrame, day: str, name: str = "is_most_recent") -> DataFrame:
    """True on rows of the latest day; the maximum is one scalar, not a window."""
    return df.withColumn(name, F.col(day) == df.agg(F.max(day)).scalar())


def lowest(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in a total order: a distributed top-k."""
    return df.orderBy(*order).limit(n)
