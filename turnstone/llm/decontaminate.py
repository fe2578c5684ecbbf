"""Benchmark passages inside documents: SimHash windows of item size, multi-index blocks, exact check.

Every position of every document starts a window as long as an item (item lengths
are rounded down on a scale with steps of a fifth; the probe is that much of the item).  A
window's SimHash comes from running bit counts.  Four 16-bit blocks with a table of
all values near an item's block find every window within the radius: a fingerprint
within ``RADIUS`` bits differs in at most ``RADIUS // 4`` bits of some block.
A candidate then counts only if the weighted Jaccard similarity of the five-word
shingles (with multiplicities) of item and window is 0.8 or more.

Windows that the end of a text or its beginning cuts off are shorter than the item.
They need no fingerprint: an item that most of its shingles name in the last (first)
words of a text is compared with every such window.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.common import slices, texts
from turnstone.llm.hashing import hash_words, mixed, separators
from turnstone.llm.simhash import simhash

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS = 4
#: Bytes of item texts that one pass over the documents carries; more items take more passes.
PASS_BYTES = 8 << 20
#: Windows that one numpy step sees, so that its arrays stay in cache.
STEP = 8192
#: Words are runs of letters and digits: every other ASCII byte ends one.
GAPS = separators(bytes(b for b in range(128) if not chr(b).isalnum()))
_TURN = np.uint64(0x9E3779B97F4A7C15)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    count = len(hashes) - size + 1
    if count < 1:
        return hashes[:0]
    out = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        out = out * _TURN + hashes[i : i + count]
    return mixed(out)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the lesser counts over the sum of the greater counts."""
    left, right = Counter(a.tolist()), Counter(b.tolist())
    both = sum((left & right).values())
    return both / (len(a) + len(b) - both)


def _rounded(count: int) -> int:
    """The largest step of the length scale that is not above ``count``."""
    step = at = 1
    while at <= count:
        step, at = at, max(at + 1, at * 6 // 5)
    return step


def _near(block: int, bits: int, radius: int) -> np.ndarray:
    values = np.arange(1 << bits, dtype=np.uint32)
    return np.bitwise_count(values ^ np.uint32(block)) <= radius


class Probes:
    """Items of one probe length and shingle size: fingerprints and block tables."""

    def __init__(self, size: int, length: int, radius: int):
        self.size, self.length, self.radius = size, length, radius
        self.items: list[tuple[int | None, np.ndarray]] = []
        self.prints = np.zeros(0, dtype=np.uint64)

    def add(self, item_id, all_shingles: np.ndarray) -> None:
        self.items.append((item_id, all_shingles))

    def close(self) -> "Probes":
        probes = np.concatenate([s[: self.length] for _, s in self.items])
        self.prints = simhash(probes, np.full(len(self.items), self.length))
        width = 64 // BLOCKS
        self.tables = np.zeros((BLOCKS, 1 << width), dtype=bool)
        for block in range(BLOCKS):
            for value in {int(p) >> (width * block) & ((1 << width) - 1) for p in self.prints}:
                self.tables[block] |= _near(value, width, self.radius // BLOCKS)
        return self

    def match(self, windows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each item the positions of the windows within the radius."""
        parts = windows.view(np.uint16).reshape(-1, BLOCKS)
        hit = self.tables[0].take(parts[:, 0], mode="clip")
        for block in range(1, BLOCKS):
            hit |= self.tables[block].take(parts[:, block], mode="clip")
        found = np.flatnonzero(hit)
        if found.size:
            values = windows[found]
            for number, own in enumerate(self.prints):
                near = found[np.bitwise_count(values ^ own) <= self.radius]
                if near.size:
                    yield number, near


def probe_groups(items: list[tuple[int | None, bytes]], radius: int) -> list[Probes]:
    """Items by shingle size and rounded length; items without a word are left out."""
    groups: dict[tuple[int, int], Probes] = {}
    hashes, counts = hash_words([t for _, t in items], True, GAPS)
    for (item_id, _), own in zip(items, np.split(hashes, np.cumsum(counts)[:-1]) if items else []):
        if len(own):
            size = min(SHINGLE_WORDS, len(own))
            found = shingles(own, size)
            key = (size, _rounded(len(found)))
            groups.setdefault(key, Probes(*key, radius)).add(item_id, found)
    return [g.close() for g in groups.values()]


class Ends:
    """Which items of one shingle size hold a shingle, for the windows at both ends of a text."""

    def __init__(self, size: int, groups: list[Probes]):
        self.size = size
        self.items = [(g, number) for g in groups for number in range(len(g.items))]
        sets = [np.unique(g.items[number][1]) for g, number in self.items]
        self.lengths = np.array([len(g.items[number][1]) for g, number in self.items])
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.holders = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]
        self.keys, counts = np.unique(values, return_counts=True)
        self.stops = np.cumsum(counts)
        self.mask = np.uint64((1 << max(16, len(self.keys).bit_length() + 4)) - 1)
        self.table = np.zeros(int(self.mask) + 1, dtype=bool)
        self.table[(self.keys & self.mask).astype(np.int64)] = True

    def named(self, found: np.ndarray, first: np.ndarray, held: np.ndarray, similarity: float) -> Iterator[tuple[int, int, bool]]:
        """``row, item, at_end`` where enough of an item's shingles stand within its length of an end."""
        at = np.flatnonzero(self.table[(found & self.mask).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.keys, found[at]), len(self.keys) - 1)
        true = self.keys[place] == found[at]
        at, place = at[true], place[true]
        row = np.searchsorted(first, at, side="right") - 1
        before, after = at - first[row], first[row] + held[row] - at
        most = self.lengths.max()
        near = (after > 0) & ((before < most) | (after <= most))  # runs over the border of two texts are no shingles
        row, place, before, after = (x[near] for x in (row, place, before, after))
        counts = np.diff(self.stops, prepend=0)[place]
        item = self.holders[np.repeat(self.stops[place] - np.cumsum(counts), counts) + np.arange(counts.sum())]
        row, before, after = (np.repeat(x, counts) for x in (row, before, after))
        for at_end, inside in ((False, before < self.lengths[item]), (True, after <= self.lengths[item])):
            pair, times = np.unique(row[inside] * len(self.items) + item[inside], return_counts=True)
            for p in pair[times >= similarity * self.lengths[pair % len(self.items)] - 1e-9].tolist():
                yield *divmod(p, len(self.items)), at_end


def item_ends(groups: list[Probes]) -> list[Ends]:
    """One for each shingle size of the items."""
    return [Ends(size, [g for g in groups if g.size == size]) for size in sorted({g.size for g in groups})]


def _bit_counts(values: np.ndarray, most: int) -> np.ndarray:
    """Running counts of each of the 64 bits, in lanes of 64-bit sums.

    Lanes may carry into each other, but the difference of two sums is right modulo
    2**64, and no lane of it can overflow: it counts ``most`` shingles at most.
    """
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32
    bits = np.unpackbits(values.view(np.uint8), bitorder="little").reshape(-1, 64).astype(kind, copy=False)
    lanes = bits.view(np.uint64)
    out = np.zeros((len(values) + 1, lanes.shape[1]), dtype=np.uint64)
    np.cumsum(lanes, axis=0, out=out[1:])
    return out


def _windows(counts: np.ndarray, length: int, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """Fingerprints of the windows of ``length`` shingles, a step of them at a time."""
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32
    half = kind(length // 2)
    for at in range(0, len(counts) - length, STEP):
        stop = min(at + STEP, len(counts) - length)
        ones = (counts[at + length : stop + length] - counts[at:stop]).view(kind)
        yield at, np.packbits(ones > half, bitorder="little").view(np.uint64)


def _search(hashes: np.ndarray, words: np.ndarray, groups: list[Probes], ends: list[Ends], similarity: float):
    """``row, item_id, start, words, similarity`` of the best window of each item in each text."""
    best: dict[tuple[int, int, int], tuple[float, int, int]] = {}
    row_of = np.repeat(np.arange(len(words)), words)
    first = np.concatenate([[0], np.cumsum(words)])
    for size in sorted({g.size for g in groups}):
        own = [g for g in groups if g.size == size]
        found = shingles(hashes, size)
        if not len(found) or not own:
            continue
        most = max(g.length for g in own)
        counts = _bit_counts(found, most)
        held = np.maximum(np.diff(first) - size + 1, 0)  # shingles of each text
        for group in own:
            for at, prints in _windows(counts, group.length, most):
                for number, near in group.match(prints):
                    for start in (near + at).tolist():
                        row = int(row_of[start])
                        end = int(first[row] + held[row])
                        if start + group.length <= end:
                            _keep(best, group, number, row, start, int(first[row]), end, found, similarity)
            short = np.flatnonzero((held > 0) & (held < group.length) & (held >= similarity * group.length))
            if short.size:  # texts shorter than the probe are one window
                values = np.concatenate([found[first[r] : first[r] + held[r]] for r in short])
                for number, near in group.match(simhash(values, held[short])):
                    for row in short[near].tolist():
                        start = int(first[row])
                        _keep(best, group, number, row, start, start, start + int(held[row]), found, similarity)
        for cut in (e for e in ends if e.size == size):
            for row, item, at_end in cut.named(found, first[:-1], held, similarity):
                group, number = cut.items[item]
                count = len(group.items[number][1])
                base, end = int(first[row]), int(first[row] + held[row])
                for length in range(math.ceil(similarity * count - 1e-9), min(count, int(held[row]) + 1)):
                    if at_end:
                        _keep(best, group, number, row, end - length, base, end, found, similarity)
                    else:
                        _keep(best, group, number, row, base, base, base + length, found, similarity)
    for (row, _, _), (score, start, length, item_id) in sorted(best.items(), key=lambda x: (x[0][0], x[1][1], -x[1][0])):
        yield row, item_id, start, length, score


def _keep(best, group, number, row, start, base, end, found, similarity) -> None:
    item_id, item = group.items[number]
    window = found[start : min(start + len(item), end)]
    score = weighted_similarity(item, window)
    key = (row, id(group), number)
    if score >= similarity and (key not in best or (score, base - start) > (best[key][0], -best[key][1])):
        best[key] = (score, start - base, len(window) + group.size - 1, item_id)


LEAKS = "doc_id long, item_id long, start_word long, window_words long, similarity double"


def _pass(documents: DataFrame, items: list[tuple[int | None, bytes]], radius: int, similarity: float) -> DataFrame:
    probes = probe_groups(items, radius)
    shared = documents.sparkSession.sparkContext.broadcast((probes, item_ends(probes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, ends = shared.value
        for part in slices(batches, "text"):
            hashes, counts = hash_words(texts(part, "text"), True, GAPS)
            found = list(_search(hashes, counts, groups, ends, similarity))
            if found:
                rows, *columns = zip(*found)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                ids = part.column("doc_id").take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], [x.split()[0] for x in LEAKS.split(", ")])

    return documents.mapInArrow(run, LEAKS)


def leaks(documents: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document row and item whose best window reaches the similarity.

    ``start_word`` counts from 0.  Null and empty texts and items never match; items of
    fewer than five words are one shingle.  Repeated rows are judged each on its own.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // PASS_BYTES))
    out = None
    for number in range(passes):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number).collect()  # bounded by PASS_BYTES
        found = _pass(rows, sorted(((r.item_id, r.text.encode()) for r in own), key=str), radius, similarity)
        out = found if out is None else out.unionByName(found)
    return out


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no item is found; rows without an id stay only if their own text has none."""
    known = documents.where(F.col("doc_id").isNotNull())
    clean = known.join(leaks(known, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(documents.columns)
    unnamed = documents.where(F.col("doc_id").isNull())
    marked = unnamed.withColumn("doc_id", F.xxhash64("text"))
    found = leaks(marked, benchmark).select("doc_id").distinct()
    rest = marked.join(found, "doc_id", "left_anti").withColumn("doc_id", F.lit(None).cast(documents.schema["doc_id"].dataType))
    return clean.unionByName(rest.select(documents.columns))
