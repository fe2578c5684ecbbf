"""Near-duplicates by SimHash: fingerprints, BK-tree search in shards, connected components.

Distinct fingerprints, not documents, are compared, so a group of exact copies is
one node.  Two fingerprints within two bits agree in two of four 16-bit blocks at
least (pigeonhole), so each fingerprint goes to six shards, one for each pair of
blocks, and every link lies inside some shard.  A shard is searched with a BK-tree:
children are keyed by their integer Hamming distance to the parent and a query
follows only the edges within the radius.  A shard with many members is dealt to
several tasks, each of which gets the whole tree and its own part of the queries.
A task reports each member with the least member it reaches, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from turnstone.llm.common import slices, staged, texts, words
from turnstone.session import cut_lineage

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
BLOCKS = 4
#: Queries that one task puts to one tree.
TREE_QUERIES = 4096
SIGN = np.uint64(1 << 63)


def simhash(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of ``counts`` hashes; zero for an empty run."""
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if full.size:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        packed = np.packbits(2 * ones > counts[full][:, None], axis=1, bitorder="little")
        out[full] = packed.view(np.uint64).ravel()
    return out


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each shingle of a text; a shorter text is one shingle, an empty one none."""
    tokens = words(text)
    if len(tokens) < size:
        return [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)] if tokens else []
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return [digest(join(s), SEED) for s in zip(*(tokens[i:] for i in range(size)))]


def fingerprints(documents: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` (signed long) of every row; null and empty texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            each = [shingle_hashes(t, size) for t in texts(part, "text")]
            counts = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
            flat = np.fromiter((h for x in each for h in x), dtype=np.uint64, count=int(counts.sum()))
            fp = pa.array(simhash(flat, counts).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), fp], ["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Distinct 64-bit fingerprints; each edge carries the distance of the child to its parent."""

    def __init__(self, values: np.ndarray):
        self.values = values
        plain = [int(v) for v in values]
        self.children: list[dict[int, int]] = [{} for _ in plain]
        for node in range(1, len(plain)):
            at = 0
            while True:
                apart = (plain[at] ^ plain[node]).bit_count()
                below = self.children[at].get(apart)
                if below is None:
                    self.children[at][apart] = node
                    break
                at = below

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node that any query reaches: the node and the queries within the radius.

        All queries descend together; an edge is followed by those whose distance to
        the node differs from the edge's by at most the radius.
        """
        if not len(self.values):
            return
        stack = [(0, np.arange(len(queries)))]
        while stack:
            node, active = stack.pop()
            apart = np.bitwise_count(queries[active] ^ self.values[node]).astype(np.int16)
            near = active[apart <= radius]
            if near.size:
                yield node, near
            for edge, child in self.children[node].items():
                follow = active[np.abs(apart - edge) <= radius]
                if follow.size:
                    stack.append((child, follow))


def _least_reached(members: np.ndarray, asks: np.ndarray, radius: int) -> np.ndarray:
    """For each member of a shard the position of the least member linked to it."""
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = np.flatnonzero(asks)
    for node, near in BKTree(members).within(members[where], radius):
        for other in where[near]:
            a, b = root(node), root(int(other))
            if a != b:
                parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(len(members))], dtype=np.int64)


def _search(radius: int):
    """Star edges ``a, b`` (b the least of the shard's linked members) from sorted shard rows."""

    def edges(shard: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
        fp, asks = np.concatenate([x[0] for x in shard]), np.concatenate([x[1] for x in shard])
        if len(fp) < 2:
            return None
        least = _least_reached(fp.view(np.uint64), asks, radius)
        moved = np.flatnonzero(least != np.arange(len(fp)))
        return (fp[moved], fp[least[moved]]) if moved.size else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_rows = None, []

        def close():
            found = edges(open_rows) if open_rows else None
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            shard, salt, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            asks = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(fp)]):
                key = (shard[lo], salt[lo])
                if key != open_key:
                    yield from close()
                    open_key, open_rows = key, []
                open_rows.append((fp[lo:hi], asks[lo:hi]))
        yield from close()

    return run


def _shards(blocks: int, radius: int):
    """One long for each set of blocks that two linked fingerprints can agree in: set number and bits."""
    width = 64 // blocks
    out = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << width) - 1) << (width * b) for b in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed))))
    return F.array(*out)


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, queries: int = TREE_QUERIES) -> DataFrame:
    """Edges ``a, b`` that connect all distinct fingerprints linked within the radius.

    ``distinct`` has one row for each ``fp``.  Needs more blocks than the radius.
    """
    if blocks <= radius or 64 % blocks:
        raise ValueError("blocks must divide 64 and exceed the radius")
    keyed = distinct.select("fp", F.explode(_shards(blocks, radius)).alias("shard"))
    sizes = keyed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / queries).cast("int")
    dealt = (
        keyed.join(sizes, "shard")
        .withColumn("parts", parts)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("shard", "part", "fp", (F.pmod(F.xxhash64("fp"), F.col("parts")) == F.col("part")).alias("asks"))
    )
    ordered = dealt.repartition("shard", "part").sortWithinPartitions("shard", "part", "fp")
    return ordered.mapInArrow(_search(radius), "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``node, root`` of every node of the edges ``a, b`` but the roots; a root is the least node of those it reaches.

    Alternates two steps until nothing changes: each node's larger neighbours move to
    its least neighbour, then its smaller neighbours and itself do.
    """
    spark = edges.sparkSession
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        moved = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = cut_lineage(moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds on {spark.sparkContext.applicationId}")


def near_duplicates(documents: DataFrame, radius: int = RADIUS, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id its fingerprint reaches by links.

    Null ids take part but never name a component unless all ids in it are null.
    Repeated rows give repeated result rows.  Only ``doc_id`` and ``text`` are read.
    """
    rows = staged(fingerprints(documents, size), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    linked = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(linked, distinct.fp == linked.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def hex64(column: str):
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def one_of_each_group(documents: DataFrame, radius: int = RADIUS, size: int = SHINGLE_WORDS) -> DataFrame:
    """All columns of the document with the smallest id of each group.

    Of rows with one id the one whose text, then other plain columns, sort first stays.  Rows
    without an id can't be told apart and all stay.
    """
    kept = near_duplicates(documents, radius, size).where("doc_id = component_id").select("doc_id").distinct()
    known = documents.join(kept, "doc_id", "left_semi")
    plain = [f.name for f in documents.schema.fields if f.name not in ("doc_id", "text") and isinstance(f.dataType, AtomicType)]
    first = known.groupBy("doc_id").agg(F.min_by(F.struct(*known.columns), F.struct("text", *plain)).alias("row"))
    return first.select("row.*").unionByName(documents.where(F.col("doc_id").isNull()))
