"""Join patterns built from equi joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.operators.scan import ROWS_PER_BUCKET, even_buckets, prefix_scan, seconds


def exists_flag(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """1 where the key occurs in ``other``, else 0; ``other`` may repeat keys."""
    marks = other.select(*keys).distinct().withColumn("_seen", F.lit(1))
    return df.join(marks, list(keys), "left").withColumn(name, F.coalesce("_seen", F.lit(0))).drop("_seen")


def not_in(df: DataFrame, other: DataFrame, key: str, null_aware: bool = False) -> DataFrame:
    """Rows whose key is not listed.

    ``null_aware=True`` follows SQL ``NOT IN``: a null in the list leaves nothing,
    and a null key passes only an empty list.
    """
    listed = other.select(key).distinct()
    kept = df.join(listed.where(F.col(key).isNotNull()), key, "left_anti")
    if not null_aware:
        return kept
    facts = other.agg(
        F.struct(
            F.count("*").alias("n"), F.count_if(F.col(key).isNull()).alias("nulls")
        ).alias("f")
    ).scalar()
    return kept.where((facts["n"] == 0) | ((facts["nulls"] == 0) & F.col(key).isNotNull()))


def point_in_time(facts: DataFrame, cutoffs: DataFrame, key: str, when: str, cutoff: str, as_of) -> DataFrame:
    """Facts up to each key's own cutoff, or up to ``as_of`` where it has none."""
    joined = facts.join(cutoffs.select(key, cutoff), key, "left")
    return joined.where(F.col(when) <= F.coalesce(F.col(cutoff), F.lit(as_of)))


def within_window(
    facts: DataFrame, windows: DataFrame, key: str, when: str, start: str, end: str, rows: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Facts inside their key's [start, end] window.

    Time is cut at borders that leave about ``rows`` facts between two of them.  A window goes to each
    stretch it touches, so facts and windows meet by (key, stretch) and a hot key is spread; a fact
    lies in one stretch, so no pair comes twice.
    """
    cells = even_buckets(facts, seconds(F.col(when)), rows)
    if not cells.borders:
        return facts.join(windows, key).where(F.col(when).between(F.col(start), F.col(end)))
    touched = cells.of(cells.of(windows, "_from", seconds(F.col(start))), "_to", seconds(F.col(end))).where("_from <= _to")
    spread = touched.withColumn("_cell", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")
    met = cells.of(facts, "_cell").join(spread, [key, "_cell"]).drop("_cell")
    return met.where(F.col(when).between(F.col(start), F.col(end)))


def asof_backward(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, rows: int = ROWS_PER_BUCKET,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Last ``right`` row at or before each ``left`` row of the same key.

    Both sides are stacked on one time axis and the latest right-hand row is
    carried forward by the bucketed scan: one pass, no pairs, and a hot key is spread over
    stretches of time of about ``rows`` rows each.  ``left`` rows without a match stay, with nulls.
    """
    lcols = [c for c in left.columns if c != key]
    packed = F.struct(F.col(right_time).alias("t"), *[F.col(c) for c in carry])
    lrows = left.where(F.col(key).isNotNull()).select(
        key,
        F.col(left_time).alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*lcols).alias("_row"),
    )
    rrows = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        key, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), packed.alias("_match")
    )
    stacked = lrows.unionByName(rrows, allowMissingColumns=True)
    scanned = prefix_scan(
        stacked, [key], ["_t", "_side"], even_buckets(stacked, seconds(F.col("_t")), rows), maxes={"_last": F.col("_match")}
    )
    matched = scanned.where(F.col("_side") == 1).select(
        key, *[F.col(f"_row.{c}").alias(c) for c in lcols],
        F.col("_last.t").alias(right_time), *[F.col(f"_last.{c}").alias(c) for c in carry],
    )
    unkeyed = left.where(F.col(key).isNull())
    return matched.unionByName(unkeyed, allowMissingColumns=True)


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """The row that sorts first per key, found by a map-side combined minimum.

    ``order`` must be ascending expressions; negate numbers to sort them down.
    """
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c) for c in keep])
    best = df.groupBy(*keys).agg(F.min(ranked).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in keep])


def value_on_first_row(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str
) -> DataFrame:
    """``value`` on the first row of each key and 0 on the others.

    The order column must be distinct within a key.  The first row is found by an
    aggregate and matched by an equi join, so no key is ever sorted in one task.
    """
    first = df.groupBy(*keys).agg(F.min(order).alias("_first"))
    joined = df.join(first, list(keys))
    return joined.withColumn(
        name, F.when(F.col(order) == F.col("_first"), F.col(value)).otherwise(F.lit(0.0))
    ).drop("_first")


def pairs_from_matrix(matrix: DataFrame, row: str, columns: Sequence[str], to: str, value: str) -> DataFrame:
    """A wide square table as (row, to, value) rows, ready for a two-key join."""
    return matrix.unpivot([row], list(columns), to, value)
