"""Table access, files and publishing.

Reads are lazy and keep the parquet columns as they are, so filters and column
lists written on top of them reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Tables:
    """Lazy readers for the parquet tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame], **args: Any) -> DataFrame:
    """SQL text over DataFrames (``{name}``) with bound parameters (``:name``)."""
    return spark.sql(text, args=args or None, **views)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header row and a declared schema: no inference pass over the data."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV folder written by the executors, one file per task."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace a parquet table.  Written beside reads of other paths only."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Replace a table stored in hash buckets of its join keys.

    Two tables bucketed alike on the same keys join without moving a row, which
    pays off for the large facts that many jobs join (sales and their lines).
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create_table_as(spark: SparkSession, text: str, path: str, views: dict[str, DataFrame]) -> DataFrame:
    """Drop-and-recreate a table from a SELECT, then read it back."""
    return spark.read.parquet(write_table(spark.sql(text, **views), path))


def upsert(current: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose key is not staged, plus all staged rows.

    The staged keys are made distinct first, so the anti join moves one row per key.
    """
    kept = current.join(staged.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(staged)


def preview(df: DataFrame, n: int, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """The first ``n`` rows; ordered previews run as a distributed top-k."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def with_literal_rows(df: DataFrame, key: str, column: str, values: dict[Any, Any]) -> DataFrame:
    """Attach hand-kept values by key instead of by row position."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return df.withColumn(column, F.create_map(*pairs)[F.col(key)])
