"""The two rolling sales boards as stream jobs."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from turnstone.session import run_folder

#: Files of a micro-batch at most, so a long backlog is worked off in bounded batches.
FILES_PER_BATCH = 64
MINUTES = 60


def read_sales(spark: SparkSession, path: str, like: DataFrame, watermark_on: str, delay: str, files: int = FILES_PER_BATCH) -> DataFrame:
    """A stream over a parquet table, file or folder, with the schema of a batch read.

    The path is given as a pattern that matches itself: the file stream takes a
    plain path for a folder only.
    """
    stream = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")
    return stream.withColumn(watermark_on, F.col(watermark_on).cast("timestamp")).withWatermark(watermark_on, delay)


def windowed_counts(
    sales: DataFrame, when: str, length: str, keys: Sequence[str], aggs: Sequence[Column], slide: str | None = None
) -> DataFrame:
    """Tumbling or sliding window aggregates; state is bounded by the watermark."""
    window = F.window(when, length, slide) if slide else F.window(when, length)
    return sales.groupBy(window.alias("w"), *keys).agg(*aggs)


def minute_sales(sales: DataFrame, when: str, key: str, value: str) -> DataFrame:
    """``key, minute, n, v`` of each minute that the watermark has passed, so it never changes again.

    A hot key costs one row a minute from here on.
    """
    minutes = sales.groupBy(F.window(when, "1 minute").alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("v"))
    return minutes.select(key, F.unix_seconds("w.start").alias("minute"), "n", F.coalesce("v", F.lit(0.0)).alias("v"))


def trailing_hour(minutes: DataFrame, key: str) -> DataFrame:
    """``key, minute, sales, revenue``: of each minute with a sale the totals of the hour that ends with it.

    ``minutes`` streams the rows of ``minute_sales`` in their order.  Each key keeps the minutes of the last hour as its state.
    """

    def follow(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, counts, totals = (list(x) for x in state.get) if state.exists else ([], [], [])
        new = pd.concat(list(parts)).sort_values("minute")
        out = []
        for minute, n, v in zip(new["minute"].tolist(), new["n"].tolist(), new["v"].tolist()):
            seen.append(minute)
            counts.append(n)
            totals.append(v)
            old = next(i for i, m in enumerate(seen) if m > minute - 60 * MINUTES)
            del seen[:old], counts[:old], totals[:old]
            out.append((name[0], minute, sum(counts), sum(totals)))
        state.update((seen, counts, totals))
        yield pd.DataFrame(out, columns=[key, "minute", "sales", "revenue"])

    kind = minutes.schema[key].dataType.simpleString()
    found = minutes.groupBy(key).applyInPandasWithState(
        follow, f"{key} {kind}, minute long, sales long, revenue double", "seen array<long>, counts array<long>, totals array<double>", "append", GroupStateTimeout.NoTimeout)
    return found.withColumn("minute", F.timestamp_seconds("minute"))


def run_to_log(rows: DataFrame, label: str, key: str) -> tuple[str, DataFrame]:
    """Process everything available; the folder of the appended rows, and how many late rows each batch left out.

    A batch's rows of a key go to one file, so whoever follows the log sees a key's batches in order.  A
    batch that is repeated after a failure overwrites its own part of the log.
    """
    spark = rows.sparkSession
    out = run_folder(spark, label)
    stream = (
        rows.writeStream.outputMode("append").option("checkpointLocation", run_folder(spark, f"{label}-state"))
        .trigger(availableNow=True).foreachBatch(lambda batch, number: batch.repartition(key).write.mode("overwrite").parquet(f"{out}/batch={number:09d}")).start())
    stream.awaitTermination()
    late = [(int(p["batchId"]), sum(int(s["numRowsDroppedByWatermark"]) for s in p["stateOperators"])) for p in map(_plain, stream.recentProgress)]
    return out, spark.createDataFrame(late, "batch long, late long")


def follow_log(spark: SparkSession, folder: str, schema, files: int = FILES_PER_BATCH) -> DataFrame:
    """A stream over the log of another, batch after batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/batch=*")


def read_log(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All rows of a log."""
    return spark.read.schema(schema).parquet(f"{folder}/batch=*")


def _plain(progress) -> dict:
    return json.loads(progress.json) if hasattr(progress, "json") else progress


def run_to_table(windows: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Process everything available, then read the latest version of each window.

    Every micro-batch writes its changed windows to its own folder and overwrites
    that folder on a retry, so a restarted query never counts a batch twice.
    """
    spark = windows.sparkSession
    out = run_folder(spark, label)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = (
        windows.writeStream.outputMode("update")
        .option("checkpointLocation", run_folder(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    stream.awaitTermination()
    saved = spark.read.parquet(out)
    values = [c for c in saved.columns if c not in {*keys, "w", "batch"}]
    latest = saved.groupBy("w", *keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return latest.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, *[F.col(f"v.{c}").alias(c) for c in values]
    )
