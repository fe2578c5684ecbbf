"""Category encoders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.operators.scan import row_numbers
from turnstone.session import cut_lineage

#: Categories that are looked up in one array.
MOST_CATEGORIES = 10_000


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per listed category, named after it."""
    return df.withColumns({v: F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values}).drop(column)


def label_codes(df: DataFrame, column: str, name: str, most: int = MOST_CATEGORIES) -> DataFrame:
    """0, 1, 2, ... for the categories in sorted order; null for a null category."""
    return _coded(df, df.where(F.col(column).isNotNull()).select(column).distinct(), column, [column], name, most)


def first_seen_codes(df: DataFrame, column: str, order: str, name: str, most: int = MOST_CATEGORIES) -> DataFrame:
    """0, 1, 2, ... for the categories by where each occurs first; null for a null category."""
    seen = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_at"))
    return _coded(df, seen, column, ["_at", column], name, most)


def _coded(df: DataFrame, seen: DataFrame, column: str, order: Sequence[str], name: str, most: int) -> DataFrame:
    """Rows with the place of their category in the order.

    Up to ``most`` categories (codes, levels, weekdays) are one array that each row looks its place up in.  More of them are
    sorted by range, numbered within each range, and joined.
    """
    seen = cut_lineage(seen)
    if seen.count() <= most:
        domain = seen.agg(F.transform(F.sort_array(F.collect_list(F.struct(*order))), lambda x: x[column])).scalar()
        return df.withColumn(name, (F.array_position(domain, F.col(column)) - 1).cast("int"))
    ranges = cut_lineage(seen.repartitionByRange(*order)).withColumn("_range", F.spark_partition_id())
    codes = row_numbers(ranges, [], list(order), F.col("_range"), "_number")
    return df.join(codes.select(column, (F.col("_number") - 1).cast("int").alias(name)), column, "left")
