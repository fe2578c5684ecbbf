"""Helpers of the text operators: byte words, bounded slices of Arrow batches, shared tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.session import run_folder

UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(UPPER, UPPER.lower())
#: Bytes of text that one numpy step sees; batches are cut to it (one longer text is a step of its own).
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe against lost executors."""
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict[str, Any] = {}


def held(name: str, make: Callable[[], Any]) -> Any:
    """What a worker keeps between tasks under a name by content; a worker holds one such thing at a time."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def give_back() -> None:
    """Return freed memory to the system at the end of a task; workers live on and otherwise keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def words(text: bytes) -> list[bytes]:
    """Lower-cased words; ``bytes.split`` cuts at exactly 0x20 and 0x09-0x0D."""
    return text.translate(LOWER).split()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece hold at most ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start, base = np.cumsum(size), 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            base, start = int(ends[stop - 1]), stop


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values in each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def text_crc(column: str, modulus: int):
    """crc32 of the column as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def sampled_labels(labels: DataFrame, label: str, bound: int, keep=None) -> DataFrame:
    """At most ``bound`` labelled ids, the first in hash order; the same rows on every run.

    Repeated ids count once (toxic if any row says so, good only if every row does);
    null ids and null labels are left out.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if keep is not None:
        rows = rows.where(keep)
    pick = F.min if label == "quality" else F.max
    once = rows.groupBy("doc_id").agg(pick(label).cast("int").alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def labelled_texts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of the sampled ids.  The sample's size is bounded, so it may be broadcast."""
    return documents.select("doc_id", "text").join(F.broadcast(labels), "doc_id")
