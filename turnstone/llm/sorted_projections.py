"""Near-duplicate vectors by sorted projection passes.

Distinct vectors, not rows, are compared.  Each pass sorts them lexicographically by
concatenated random hashes (the strongest of 32 random projections and its sign) and
compares each with a bounded window of neighbours; the number of passes grows with the
number of vectors.  A window says nothing whole about a crowd of vectors that are all alike, so

* a first sweep of all passes gives each vector the least neighbour within half the
  angle of the threshold; vectors with one such reference are all linked, which needs no
  comparison and no pairs, and references of references gather a crowd;
* a second sweep takes neighbouring vectors of one crowd as one row, so that a crowd
  hides nothing that lies among it, and gives the pairs of crowds (mostly of one vector
  each) in which a link was found;
* each such pair of crowds is compared whole, in parts of bounded size, in double
  precision, which gives exact counts of links and the edges of the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.common import staged
from turnstone.llm.simhash import components

SIMILARITY = 0.9
#: Rows before each row that a pass compares it with.
WINDOW = 128
#: Projections of a hash; two vectors of cosine 0.9 have equal hashes with a probability of about a half.
PROJECTIONS = 32
#: Expected number of passes in which two vectors of cosine 0.9 share a window.
EXPECTED = 4
#: Sketches are half-precision unit vectors: a cosine moves by less than this.
SKETCH_ERROR = 0.002
#: Members of a crowd in one comparison, and members of other crowds that meet them in one task.
MEMBERS, VISITORS = 1024, 8192
JUMPS = 3
SEED = 13


def pack(rows: DataFrame) -> DataFrame:
    """``id, node, raw``: the vector as little-endian doubles and its hash; null where it can link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            out = []
            flat, sizes = column.flatten(), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            bad = np.flatnonzero(pc.is_null(flat).to_numpy(zero_copy_only=False))
            values = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False) + 0.0  # no negative zeros
            values[bad] = np.nan
            ends = np.cumsum(sizes)
            for start, stop in zip((ends - sizes).tolist(), ends.tolist()):
                own = values[start:stop]
                with np.errstate(over="ignore", invalid="ignore"):
                    norm = float(np.sqrt((own * own).sum()))
                out.append(own.astype("<f8").tobytes() if 0 < norm < math.inf else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "raw"])

    plain = rows.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    packed = plain.mapInArrow(run, "id long, raw binary")
    return packed.withColumn("node", F.when(F.col("raw").isNotNull(), F.xxhash64("raw")))


def units(column: pa.Array) -> np.ndarray:
    """Unit vectors of packed rows of one length."""
    out = np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)
    return out / np.sqrt((out * out).sum(1))[:, None]


def plan(count: int, window: int = WINDOW) -> tuple[int, int]:
    """Passes, and hashes of a pass: enough to tell ``count`` vectors apart down to a window."""
    hashes = max(1, math.ceil(math.log2(max(2, count / window)) / math.log2(2 * PROJECTIONS)))
    return EXPECTED * 2 + EXPECTED * 2**hashes, hashes + 1


def _sorted(nodes: DataFrame, passes: int, hashes: int, size: int) -> DataFrame:
    """``key, node, crowd, sketch`` of every vector in every pass, sorted by the hashes of the pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng([SEED, size]).standard_normal((passes, size, hashes * PROJECTIONS), dtype=np.float32)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                unit = units(part.column("raw")).astype(np.float32)
                sketch = pa.array([x.tobytes() for x in unit.astype("<f2")], pa.binary())
                for number in range(passes):
                    seen = (unit @ planes[number]).reshape(len(unit), hashes, PROJECTIONS)
                    best = np.abs(seen).argmax(2)
                    sign = np.take_along_axis(seen, best[:, :, None], 2)[:, :, 0] < 0
                    codes = (2 * best + sign).astype(np.uint8)
                    head = np.tile(np.frombuffer(number.to_bytes(2, "big"), dtype=np.uint8), (len(unit), 1))
                    key = pa.array([x.tobytes() for x in np.concatenate([head, codes], axis=1)], pa.binary())
                    yield pa.RecordBatch.from_arrays([key, part.column("node"), part.column("crowd"), sketch], ["key", "node", "crowd", "sketch"])

    hashed = nodes.select("node", "crowd", "raw").mapInArrow(run, "key binary, node long, crowd long, sketch binary")
    return hashed.repartitionByRange("key", "node").sortWithinPartitions("key", "node")


def _windows(batches: Iterator[pa.RecordBatch], window: int, bound: float, thin: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Node and crowd of both rows of all pairs within the window whose sketches reach the bound.

    ``thin`` keeps the first of neighbouring rows of one crowd.
    """
    held, before = None, None
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            part = batch.slice(at, 8192)
            turn = np.frombuffer(b"".join(k[:2] for k in part.column("key").to_pylist()), dtype=">u2").astype(np.int64)
            node, crowd = part.column("node").to_numpy(), part.column("crowd").to_numpy()
            sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), dtype="<f2").reshape(len(node), -1)
            if thin:
                first = np.concatenate([[before != (turn[0], crowd[0])], (turn[1:] != turn[:-1]) | (crowd[1:] != crowd[:-1])])
                before = turn[-1], crowd[-1]
                turn, node, crowd, sketch = turn[first], node[first], crowd[first], sketch[first]
            sketch = sketch.astype(np.float32)
            old = 0
            if held is not None:
                old = len(held[0])
                turn, node, crowd, sketch = (np.concatenate(x) for x in zip(held, (turn, node, crowd, sketch)))
            for lo in range(old, len(node), window):
                hi, low = min(lo + window, len(node)), max(0, lo - window)
                near = sketch[lo:hi] @ sketch[low:hi].T >= bound
                a, b = np.nonzero(near)
                a, b = a + lo, b + low
                fits = (b < a) & (a - b <= window) & (turn[a] == turn[b])
                a, b = a[fits], b[fits]
                if a.size:
                    yield node[a], crowd[a], node[b], crowd[b]
            held = turn[-window:], node[-window:], crowd[-window:], sketch[-window:]


def _nearest(ordered: DataFrame, window: int, bound: float) -> DataFrame:
    """``node, ref``: for each vector the least neighbour of all passes that is less than it and within the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, _, b, _ in _windows(batches, window, bound, thin=False):
            large, small = np.maximum(a, b), np.minimum(a, b)
            order = np.lexsort((small, large))
            large, small = large[order], small[order]
            first = np.concatenate([[True], large[1:] != large[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array(large[first]), pa.array(small[first])], ["node", "ref"])

    return ordered.mapInArrow(run, "node long, ref long").groupBy("node").agg(F.min("ref").alias("ref"))


def _met(ordered: DataFrame, window: int, bound: float) -> DataFrame:
    """``a, b``: pairs of crowds that have neighbours within the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, a, _, b in _windows(batches, window, bound, thin=True):
            apart = a != b
            if apart.any():
                a, b = a[apart], b[apart]
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return ordered.mapInArrow(run, "a long, b long").distinct()


def _jump(refs: DataFrame, nodes: DataFrame, half: float) -> DataFrame:
    """``node, ref``: the reference of the reference where it is still within the half angle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                near = (units(part.column("raw")) * units(part.column("far_raw"))).sum(1) >= half
                ref = np.where(near, part.column("far").to_numpy(), part.column("ref").to_numpy())
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(ref)], ["node", "ref"])

    further = refs.select(F.col("node").alias("ref"), F.col("ref").alias("far"))
    targets = further.join(nodes.select(F.col("node").alias("far"), F.col("raw").alias("far_raw")), "far")
    open_refs = refs.join(nodes.select("node", "raw"), "node").join(targets, "ref")
    moved = open_refs.select("node", "raw", "ref", "far", "far_raw").mapInArrow(run, "node long, ref long")
    return moved.unionByName(refs.join(further, "ref", "left_anti").select("node", "ref"))


def _compare(met: DataFrame, nodes: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Links between crowds: ``node, links`` (to be summed), and edges ``a, b``."""
    sizes = nodes.groupBy("crowd").agg(F.count("*").alias("size"))
    a, b = (sizes.select(F.col("crowd").alias(x), F.col("size").alias(f"{x}_size")) for x in ("a", "b"))
    homes = met.join(a, "a").join(b, "b").select(
        F.when(F.col("a_size") >= F.col("b_size"), F.col("a")).otherwise(F.col("b")).alias("home"),
        F.when(F.col("a_size") >= F.col("b_size"), F.col("b")).otherwise(F.col("a")).alias("visitor"),
        F.greatest("a_size", "b_size").alias("home_size"), F.least("a_size", "b_size").alias("visitor_size"))
    homes = staged(homes, "homes")
    hosts = homes.groupBy("home").agg(
        F.ceil(F.first("home_size") / MEMBERS).cast("int").alias("parts"), F.ceil(F.sum("visitor_size") / VISITORS).cast("int").alias("slots"))
    spread = lambda column, into: F.explode(F.sequence(F.lit(0), F.col(column) - 1)).alias(into)
    own = nodes.join(hosts, nodes.crowd == hosts.home).select(
        "home", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), spread("slots", "slot"), F.lit(0).alias("side"), "node", "copies", "raw")
    guests = (
        nodes.join(homes.select("home", F.col("visitor").alias("crowd")), "crowd").join(hosts, "home")
        .select("home", spread("parts", "part"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("slots")).cast("int").alias("slot"), F.lit(1).alias("side"), "node", "copies", "raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, hosts = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                home, share, slot, side, node, copies = (part.column(i).to_numpy() for i in range(6))
                unit = units(part.column("raw"))
                cuts = np.flatnonzero((home[1:] != home[:-1]) | (share[1:] != share[:-1]) | (slot[1:] != slot[:-1]) | (side[1:] != side[:-1])) + 1
                found = []
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(home)]):
                    key = home[lo], share[lo], slot[lo]
                    if key != open_key:
                        open_key, hosts = key, []
                    if not side[lo]:
                        hosts.append((node[lo:hi], copies[lo:hi], unit[lo:hi]))
                    elif hosts:
                        if len(hosts) > 1:
                            hosts = [tuple(np.concatenate(x) for x in zip(*hosts))]
                        members, times, vectors = hosts[0]
                        near = unit[lo:hi] @ vectors.T >= similarity
                        linked = near.any(1)
                        found.append((node[lo:hi][linked], (near @ times)[linked], members[near.argmax(1)][linked]))
                        reached = near.any(0)
                        found.append((members[reached], (copies[lo:hi] @ near)[reached], members[reached]))
                if found:
                    who, many, other = (np.concatenate(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(many.astype(np.int64)), pa.array(other)], ["node", "links", "other"])

    both = own.unionByName(guests).select("home", "part", "slot", "side", "node", "copies", "raw")
    dealt = both.repartition("home", "part", "slot").sortWithinPartitions("home", "part", "slot", "side")
    found = staged(dealt.mapInArrow(run, "node long, links long, other long"), "links")
    return found.select("node", "links"), found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY, window: int = WINDOW, passes: int | None = None) -> DataFrame:
    """``id, n_links, component_id`` of every row of ``vectors`` (``id``, ``vector``).

    ``n_links``: other rows whose cosine with the row is at least ``similarity`` and was found;
    ``component_id``: the smallest id that links reach, the row's own included.  Links
    are checked in double precision.  Vectors that are null, empty or zero, hold null or non-finite
    components, or have another length than most, link with nothing.  Repeated
    rows are rows like others.  Null ids take part but name a component only if all its ids are null.
    """
    packed = pack(vectors)
    ids = staged(packed.select("id", "node", F.length("raw").alias("size")), "vector-ids")
    common = ids.where("size is not null").groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return ids.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    distinct = packed.where(F.length("raw") == common["size"]).groupBy("node").agg(F.min("id").alias("low"), F.count("*").alias("copies"), F.min("raw").alias("raw"))
    nodes = staged(distinct, "vectors")
    own, hashes = plan(nodes.count(), window)
    passes = passes or own

    half = math.sqrt((1 + similarity) / 2)
    alone = nodes.withColumn("crowd", F.col("node"))
    first = staged(_nearest(_sorted(alone, passes, hashes, common["size"] // 8), window, half + SKETCH_ERROR), "refs")
    refs = first
    for _ in range(JUMPS):
        refs = staged(_jump(refs, nodes, half + 1e-9), "refs")
    members = staged(nodes.join(refs, "node", "left").select("node", "low", "copies", "raw", F.coalesce("ref", "node").alias("crowd")), "crowds")

    met = _met(_sorted(members, passes, hashes, common["size"] // 8), window, similarity - SKETCH_ERROR)
    stars = first.unionByName(refs).distinct()
    crowd = members.select("node", "crowd")
    across = (
        stars.join(crowd, "node").join(crowd.select(F.col("node").alias("ref"), F.col("crowd").alias("other")), "ref").where("crowd <> other")
        .select(F.least("crowd", "other").alias("a"), F.greatest("crowd", "other").alias("b")))
    links, edges = _compare(met.unionByName(across).distinct(), members, similarity)

    inside = members.groupBy("crowd").agg(F.sum("copies").alias("inside"))
    further = links.groupBy("node").agg(F.sum("links").alias("outside"))
    roots = components(edges.unionByName(stars.select(F.col("node").alias("a"), F.col("ref").alias("b"))))
    rooted = (
        members.select("node", "low", "crowd").join(inside, "crowd").join(further, "node", "left").join(roots, "node", "left")
        .select("node", "low", (F.col("inside") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")))
    rooted = staged(rooted, "roots")
    named = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("node", "n_links", "component_id")
    return ids.join(named, "node", "left").select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
