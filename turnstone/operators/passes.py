"""Fits that take many passes: features packed into blocks once, one sum of arrays over all blocks a pass.

A pass sends the present parameters to the tasks, each task adds up its blocks in numpy and
gives one array, and the arrays are merged in a tree, so the driver sees a few arrays
whatever the number of rows.  Parameters are as large as the model, never as the data.
Many fits (starts, folds, settings, groups) share a pass as further columns of the same matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block, and tasks whose arrays are merged before the driver sees them.
BLOCK_ROWS = 4096
FAN_IN = 32


class Blocks:
    """Columns of a table as blocks of doubles, kept for the passes of a fit; lost blocks are computed again.

    Null values count as 0.  A table of few rows in many tasks is packed again into as many tasks as it has
    full blocks, so a pass over it costs no task for a handful of rows.  Use as a context manager.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], rows: int = BLOCK_ROWS):
        self.columns, self.block_rows = list(columns), rows
        width = len(self.columns)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    block = np.column_stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(width)])
                    yield pa.RecordBatch.from_arrays([pa.array([part.num_rows]), pa.array([np.ascontiguousarray(block).tobytes()], pa.binary())], ["n", "block"])

        plain = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.columns])
        self.data, self.kept = plain.mapInArrow(pack, "n long, block binary"), []

    def __enter__(self) -> Blocks:
        self._keep(self.data)
        full = max(1, -(-self.rows // self.block_rows))
        if full < self.tasks:
            self._keep(self.data.coalesce(full).mapInArrow(self._joined, "n long, block binary"))
        return self

    def __exit__(self, *_) -> None:
        for data in self.kept:
            data.unpersist()

    def _keep(self, data: DataFrame) -> None:
        self.data = data.persist(StorageLevel.MEMORY_AND_DISK)
        self.kept.append(self.data)
        seen = self.data.select("n", F.spark_partition_id().alias("task")).agg(F.sum("n").alias("n"), (F.max("task") + 1).alias("tasks")).first()
        self.rows, self.tasks = int(seen["n"] or 0), int(seen["tasks"] or 0)

    @property
    def _joined(self) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Neighbouring small blocks as one, up to the rows of a full one."""
        most = self.block_rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows, blocks = 0, []
            for batch in batches:
                for n, block in zip(batch.column("n").to_pylist(), batch.column("block").to_pylist()):
                    if rows and rows + n > most:
                        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([b"".join(blocks)], pa.binary())], ["n", "block"])
                        rows, blocks = 0, []
                    rows, blocks = rows + n, [*blocks, block]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([b"".join(blocks)], pa.binary())], ["n", "block"])

        return run

    def total(self, part: Callable[[np.ndarray, object], np.ndarray], state: object, shape: Sequence[int], merge: Callable = np.add, start: float = 0.0) -> np.ndarray:
        """``part(block, state)`` of all blocks, merged; ``start`` everywhere without any."""
        shared = self.data.sparkSession.sparkContext.broadcast(state)
        width, shape = len(self.columns), tuple(shape)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.full(shape, start)
            for batch in batches:
                for n, block in zip(batch.column("n").to_pylist(), batch.column("block").to_pylist()):
                    out = merge(out, part(np.frombuffer(block).reshape(n, width), shared.value))
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

        def join(group: pa.Table) -> pa.Table:
            found = sorted(zip(group.column("task").to_pylist(), group.column("part").to_pylist()))
            out = np.full(shape, start)
            for _, one in found:
                out = merge(out, np.frombuffer(one).reshape(shape))
            return pa.table({"task": pa.array([found[0][0]], pa.int32()), "part": pa.array([out.tobytes()], pa.binary())})

        parts, tasks = self.data.mapInArrow(run, "part binary").select(F.spark_partition_id().alias("task"), "part"), self.tasks
        while tasks > FAN_IN:
            parts = parts.groupBy(F.floor(F.col("task") / FAN_IN).cast("int")).applyInArrow(join, "task int, part binary")
            parts = parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
            tasks = -(-tasks // FAN_IN)
        out = np.full(shape, start)
        for _, one in sorted((r["task"], bytes(r["part"])) for r in parts.collect()):
            out = merge(out, np.frombuffer(one).reshape(shape))
        shared.destroy()
        return out


def scrambled(keys: np.ndarray, *seeds: int) -> np.ndarray:
    """Evenly spread 64-bit numbers of keys and seeds."""
    value = keys.astype(np.uint64)
    with np.errstate(over="ignore"):
        for seed in (0, *seeds):
            value = value + np.uint64(seed + 1) * np.uint64(0x9E3779B97F4A7C15)
            value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            value = value ^ (value >> np.uint64(31))
    return value


def row_keys(values: np.ndarray) -> np.ndarray:
    """A key of each row by its values alone, to seven places, so draws depend neither on partitions nor on a sum's last bits."""
    key = np.zeros(len(values), dtype=np.uint64)
    for column in np.ascontiguousarray((np.round(values, 7) + 0.0).T).view(np.uint64):
        key = scrambled(key ^ column)
    return key
