"""Hard negatives of anchors, with bounds along a spanning tree of the anchors.

Anchors are cut into blocks of a fixed size; the anchors of a block form a minimum spanning
tree.  A block is put to all rows, a chunk of rows at a time.  The root's scores with a
chunk are products.  A child's score with a row differs from its parent's by the product
of the row and the edge, so by at most edge length times the row's norm; only rows
whose bounds overlap what the child looks for are scored again, and exact scores tighten
the bounds of the children below.  First each anchor looks for its best rows of the same
label (at least as good as the best found so far), then for rows of another label
within the window of a positive.  Tasks report the best few of each anchor and positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstone.llm.common import staged

#: Anchors of a tree, and rows that are compared with a tree at once.
BLOCK_ANCHORS = 1024
CHUNK_ROWS = 2048
#: Relative slack of bounds for rounding.
SLACK = 1e-9
#: Scores below this are exact in double precision.
EXACT = 1 << 53


@dataclass(frozen=True)
class Tree:
    """Anchors of a block in an order that has parents first; edge lengths; what each looks for."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parents: np.ndarray
    edges: np.ndarray


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's minimum spanning tree: an order from the root, and parent (place in the order) and edge of each."""
    count = len(vectors)
    order, parents, edges = np.zeros(count, dtype=np.int64), np.full(count, -1), np.zeros(count)
    place = np.zeros(count, dtype=np.int64)
    nearest, via = np.full(count, np.inf), np.zeros(count, dtype=np.int64)
    left = np.ones(count, dtype=bool)
    at = 0
    for step in range(count):
        order[step], place[at], left[at] = at, step, False
        if step:
            parents[step], edges[step] = place[via[at]], nearest[at]
        apart = np.sqrt(((vectors - vectors[at]).astype(np.float64) ** 2).sum(1))
        closer = left & (apart < nearest)
        nearest[closer], via[closer] = apart[closer], at
        at = int(np.argmin(np.where(left, nearest, np.inf)))
    return order, parents, edges


def make_tree(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    order, parents, edges = spanning_tree(vectors)
    return Tree(ids[order], labels[order], vectors[order], parents, edges)


class Search:
    """Exact scores of those rows of a chunk whose bounds leave an anchor's answer open."""

    def __init__(self, tree: Tree, rows: np.ndarray):
        whole = rows.dtype == np.int64 or tree.vectors.dtype == np.int64
        self.tree, self.rows = tree, rows.astype(np.int64) if whole else rows
        self.anchors = tree.vectors.astype(np.int64) if whole else tree.vectors
        norms = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
        self.slack = 1 + SLACK * norms * np.sqrt((tree.vectors.astype(np.float64) ** 2).sum(1)).max(initial=0)
        self.norms = norms * (1 + SLACK)
        self.low = np.empty((len(tree.ids), len(rows)))
        self.high = np.empty((len(tree.ids), len(rows)))
        self.scored = 0

    def bounds(self, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the anchor's scores from its parent's; the root's are its scores."""
        low, high = self.low[anchor], self.high[anchor]
        if anchor:
            parent, reach = self.tree.parents[anchor], self.tree.edges[anchor] * self.norms + self.slack
            np.subtract(self.low[parent], reach, out=low)
            np.add(self.high[parent], reach, out=high)
        else:
            low[:] = high[:] = self.rows @ self.anchors[0]
        return low, high

    def score(self, anchor: int, chosen: np.ndarray) -> np.ndarray:
        """Scores of the chosen rows, which become their bounds."""
        found = (self.rows if len(chosen) == len(self.rows) else self.rows[chosen]) @ self.anchors[anchor]
        self.low[anchor, chosen] = self.high[anchor, chosen] = found
        self.scored += len(chosen)
        return found


class Best:
    """The first few (score descending, id ascending) of each key."""

    def __init__(self, few: int):
        self.few, self.held = few, {}

    def least(self, key) -> float:
        """The score that a newcomer must reach."""
        held = self.held.get(key)
        return -np.inf if held is None or len(held[0]) < self.few else held[0][-1]

    def add(self, key, scores: np.ndarray, ids: np.ndarray) -> None:
        if key in self.held:
            scores, ids = np.concatenate([self.held[key][0], scores]), np.concatenate([self.held[key][1], ids])
        first = np.lexsort((ids, -scores))[: self.few]
        self.held[key] = scores[first], ids[first]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, label codes and vectors, ``CHUNK_ROWS`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(at, CHUNK_ROWS)
            yield part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of little-endian doubles; scores beyond 2**53 are taken in integers."""
    out = np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)
    return out if (out**2).sum(1).max(initial=0) < EXACT else out.astype(np.int64)


def _positives(rows: DataFrame, tree: Tree, few: int) -> DataFrame:
    """``at, id, score``: of each task the best rows of each anchor's label."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, best = shared.value, Best(few)
        for ids, labels, vectors in _chunks(batches):
            search = Search(tree, vectors)
            for anchor in range(len(tree.ids)):
                _, high = search.bounds(anchor)
                chosen = np.flatnonzero((labels == tree.labels[anchor]) & (ids != tree.ids[anchor]) & (high >= best.least(anchor)))
                if chosen.size:
                    best.add(anchor, search.score(anchor, chosen), ids[chosen])
        yield _report([(anchor, -1, i, s) for anchor, (scores, ids) in best.held.items() for s, i in zip(scores, ids)])

    return rows.mapInArrow(run, REPORT)


def _negatives(rows: DataFrame, tree: Tree, windows: dict[int, list[tuple[int, int, int]]], few: int, share: tuple[int, int]) -> DataFrame:
    """``at, positive, id, score``: of each task the best rows of other labels in each positive's window."""
    shared = rows.sparkSession.sparkContext.broadcast((tree, windows))
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tree, windows), best = shared.value, Best(few)
        for ids, labels, vectors in _chunks(batches):
            search = Search(tree, vectors)
            for anchor in range(len(tree.ids)):
                low, high = search.bounds(anchor)
                open_rows = np.zeros(len(ids), dtype=bool)
                for number, _, score in windows.get(anchor, ()):
                    open_rows |= (high >= max(num * score / den, best.least((anchor, number)))) & (low <= score)
                chosen = np.flatnonzero(open_rows & (labels != tree.labels[anchor]))
                if chosen.size:
                    found = search.score(anchor, chosen)
                    exact = found if found.dtype == np.float64 else found.astype(object)  # whole numbers without overflow
                    for number, _, score in windows[anchor]:
                        inside = np.flatnonzero((num * score <= den * exact) & (found <= score))
                        if inside.size:
                            best.add((anchor, number), found[inside], ids[chosen[inside]])
        yield _report([(a, n, i, s) for (a, n), (scores, ids) in best.held.items() for s, i in zip(scores, ids)])

    return rows.mapInArrow(run, REPORT)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
REPORT = "at int, number int, id long, score long"


def _report(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 4
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([int(x) for x in c], k) for c, k in zip(columns, kinds)], ["at", "number", "id", "score"])


def _first(found: DataFrame, keys: list[str], few: int) -> DataFrame:
    """The best few of each key over all tasks, which report at most ``few`` each."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= few)


def _trees(anchors: DataFrame, block: int) -> DataFrame:
    """``block, ids, labels, vectors``: anchors in blocks of about ``block``, dealt by hash."""
    blocks = max(1, -(-anchors.count() // block))
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int"))
    gathered = dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("id", "label", "vector"))).alias("all"))
    return gathered.selectExpr("block", "all.id as ids", "all.label as labels", "all.vector as vectors")


def mine(rows: DataFrame, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), block: int = BLOCK_ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``id`` (long), ``label`` (integer), ``vector`` (array of integral doubles) and
    ``is_anchor``.  A positive is one of an anchor's first rows of its label, a negative
    one of the first rows of other labels whose score is between the share of the
    positive's score and that score; higher scores come first, ties by smaller id.

    Rows with a null id, label or vector, with a null or non-finite component, whose scores
    may not fit a long (squared length of 2**62 or more), or whose vector has another length
    than most take no part.  Rows of one id are rows like others, but none is a positive of
    an anchor of its own id.
    """
    spark = rows.sparkSession
    fine = F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall(
        F.coalesce("vector", F.array(F.lit(None).cast("double"))), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    used = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<double>").alias("vector"), "is_anchor").where(fine)
    used = used.where(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x) < float(1 << 62))
    used = staged(_packed(used), "vectors")
    common = used.groupBy(F.length("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None or not common["size"]:
        return spark.createDataFrame([], RESULT)
    used = used.where(F.length("vector") == common["size"])
    trees = staged(_trees(used.where("is_anchor").select("id", "label", "vector"), block), "anchors")
    out = None
    for number in sorted(r.block for r in trees.select("block").collect()):
        got = trees.where(F.col("block") == number).first()  # one block: bounded
        tree = make_tree(np.array(got.ids, dtype=np.int64), np.array(got.labels, dtype=np.int64), _matrix(pa.array([bytes(v) for v in got.vectors], pa.binary())))
        plain = used.select("id", "label", "vector")
        best = _first(_positives(plain, tree, positives), ["at"], positives).collect()  # a few rows for each anchor of the block
        windows: dict[int, list[tuple[int, int, int]]] = {}
        for r in sorted(best, key=lambda r: (r["at"], r["rank"])):
            windows.setdefault(r["at"], []).append((r["rank"], r["id"], r["score"]))
        found = _first(_negatives(plain, tree, windows, negatives, share), ["at", "number"], negatives)
        known = spark.createDataFrame(
            [(at, n, int(tree.ids[at]), i, s) for at, w in windows.items() for n, i, s in w],
            "at int, number int, anchor_id long, positive_id long, positive_score long")
        part = found.join(F.broadcast(known), ["at", "number"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        part = staged(part, f"negatives-{number}")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], RESULT)


def _packed(used: DataFrame) -> DataFrame:
    """The vector as the bytes of little-endian doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
            packed = pa.array([x.astype("<f8").tobytes() for x in np.split(flat, ends[:-1])] if len(column) else [], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), packed, batch.column("is_anchor")], ["id", "label", "vector", "is_anchor"])

    return used.mapInArrow(run, "id long, label long, vector binary, is_anchor boolean")
