"""URL rules by a Bloom filter cascade over the keys of the corpus.

The keys of a url are every parent domain of its host joined to every beginning of
its path that is as long as some rule's path.  A rule fits exactly if its key is
among them.  Level 1 of the cascade encodes the listed keys; level 2 the keys of the
corpus that level 1 lets through wrongly; level 3 the listed keys that level 2 lets
through; and so on until a level lets nothing through.  For every key of the corpus the parity
of the first level that refuses it tells whether it is listed: exact, and no join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.llm.common import staged

#: Listed keys that one cascade may hold; its filters are broadcast.
MAX_LISTED = 2_000_000
MAX_LEVELS = 64
#: Later levels refuse half of the other side's keys.
LATER_RATE = 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.substring_index(_rest(url), "#", 1)
    host = F.substring_index(F.substring_index(rest, "/", 1), "?", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    rest = F.substring_index(F.substring_index(_rest(url), "#", 1), "?", 1)
    slash = F.instr(rest, "/")
    return F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise(F.lit(""))


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def keys_of(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """All keys that a rule fitting this url can have: parent domain + beginning of the path."""
    labels = F.split(host, r"\.", -1)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

    def of_length(length: int) -> Column:
        start = F.substring(path, 1, length)
        return F.when(F.length(path) >= length, F.transform(domains, lambda d: F.concat(d, start))).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of_length, sorted(set(path_lengths))))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: bits in 64-bit words, number of hash functions, salt."""

    words: np.ndarray
    hashes: int
    salt: int

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        bits = np.uint64(len(self.words) * 64)
        out = np.ones(len(first), dtype=bool)
        for place in _places(first, second, self.hashes, self.salt):
            at = place % bits
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _places(first: np.ndarray, second: np.ndarray, hashes: int, salt: int) -> Iterator[np.ndarray]:
    """The hash values of a key at one level; each level's are independent of the others'."""
    turn = np.uint64((salt * 0x9E3779B97F4A7C15 + 0x85EBCA6B) % (1 << 64))
    a = (first ^ turn) * np.uint64(0xD6E8FEB86659FD93)
    a ^= a >> np.uint64(32)
    b = ((second + turn) * np.uint64(0xFF51AFD7ED558CCD)) | np.uint64(1)
    b ^= (b >> np.uint64(33)) << np.uint64(1)
    for i in range(hashes):
        value = a + np.uint64(i) * b
        yield value ^ (value >> np.uint64(31))


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select(F.xxhash64("key").alias("first"), F.xxhash64(F.lit(1), F.col("key")).alias("second"))


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for i in range(2))


def _build(pairs: DataFrame, count: int, rate: float, salt: int) -> Level:
    """The filter of ``count`` hashed keys: each task ORs its bits, then words are ORed by number."""
    hashes = max(1, round(-math.log2(rate)))
    size = max(1, math.ceil(count * hashes / math.log(2) / 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, int] = {}
        for batch in batches:
            for place in _places(*_pairs(batch), hashes, salt):
                at = place % np.uint64(size * 64)
                for word, bit in zip((at >> np.uint64(6)).tolist(), (at & np.uint64(63)).tolist()):
                    own[word] = own.get(word, 0) | 1 << bit
        values = np.array(list(own.values()), dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array(values, pa.int64())], ["word", "bits"])

    words = np.zeros(size, dtype=np.uint64)
    for row in pairs.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        words[row.word] = row.bits % (1 << 64)  # at most ``size`` rows, bounded by MAX_LISTED
    return Level(words, hashes, salt)


def _let_through(pairs: DataFrame, level: Level) -> DataFrame:
    shared = pairs.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(shared.value.holds(*_pairs(batch))))

    return pairs.mapInArrow(run, pairs.schema)


def build_cascade(listed: DataFrame, corpus_keys: DataFrame) -> list[Level]:
    """The levels for the keys (column ``key``) of the list over those of the corpus.

    The list may hold up to ``MAX_LISTED`` keys, in proportion to which all levels are
    sized; a longer one is an error (split it and judge by each part).  Corpus keys need
    not be distinct; only those that level 1 lets through are kept.
    """
    spark = corpus_keys.sparkSession
    wanted = staged(_hashed(listed.where("key is not null").distinct()).distinct(), "listed")
    count = wanted.count()
    if count > MAX_LISTED:
        raise ValueError(f"{count} listed keys; one cascade holds {MAX_LISTED} at most")
    if not count:
        return []
    universe = corpus_keys.agg(F.approx_count_distinct("key")).first()[0]
    level = _build(wanted, count, min(0.5, max(1e-9, count * math.sqrt(0.5) / max(universe, 1))), 1)
    wrong = staged(_let_through(_hashed(corpus_keys), level).distinct().join(wanted, ["first", "second"], "left_anti"), "passed")
    inside, outside, levels = wanted, wrong, [level]
    left = outside.count()
    while left:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: two keys have equal hashes")
        level = _build(outside, left, LATER_RATE, len(levels) + 1)
        levels.append(level)
        inside, outside = outside, staged(_let_through(inside, level), "passed")
        left = outside.count()
    return levels


def listed(levels: list[Level], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether each hashed key of the corpus is listed: refused first by an even level (or by none of an odd number)."""
    out = np.zeros(len(first), dtype=bool)
    open_ = np.arange(len(first))
    for number, level in enumerate(levels, 1):
        held = level.holds(first[open_], second[open_])
        out[open_[~held]] = number % 2 == 0
        open_ = open_[held]
    out[open_] = len(levels) % 2 == 1
    return out


def members(rows: DataFrame, levels: list[Level], column: str = "keys") -> DataFrame:
    """``rows`` with the array of keys cut down to the listed ones.  Keys must be the corpus's own."""
    shared = rows.sparkSession.sparkContext.broadcast(levels)
    hashed = rows.withColumn("first_", F.transform(column, lambda k: F.xxhash64(k))).withColumn("second_", F.transform(column, lambda k: F.xxhash64(F.lit(1), k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            firsts, seconds = batch.column("first_"), batch.column("second_")
            pair = tuple(x.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for x in (firsts, seconds))
            counts = pc.fill_null(pc.list_value_length(firsts), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            marks = pa.ListArray.from_arrays(offsets, pa.array(listed(shared.value, *pair)))
            keep = [n for n in batch.schema.names if n not in ("first_", "second_")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), marks], [*keep, "marks_"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    marked = hashed.mapInArrow(run, f"{fields}, marks_ array<boolean>")
    kept = F.transform(F.filter(F.arrays_zip(F.col(column).alias("k"), F.col("marks_").alias("m")), lambda x: x["m"]), lambda x: x["k"])
    return marked.withColumn(column, kept).drop("marks_")


def judge(pages: DataFrame, rules: dict[str, str], blocked: DataFrame | None = None) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` of every row.

    ``rules`` maps a rule (host and path, ``net/fr/``) to ``allow`` or ``block``; the
    longest fitting one decides.  Without one, a host below an entry of ``blocked``
    (column ``host``) is blocked and any other allowed.  Both lists go through one
    cascade.  Null urls, and those without ``://``, have an empty host and path and are allowed.
    """
    spark = pages.sparkSession
    split = {r: len(r) - len(r.split("/", 1)[0]) for r in rules}
    if not all(split.values()):
        raise ValueError("a rule needs a path")
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keyed = rows.withColumn("keys", keys_of(F.col("host"), F.col("path"), [0, *split.values()]))
    entries = spark.createDataFrame([(r,) for r in rules], "key string")
    if blocked is not None:
        entries = entries.unionByName(blocked.select(F.col("host").alias("key")))
    levels = build_cascade(entries, keyed.select(F.explode("keys").alias("key")))
    found = members(keyed, levels)
    rule_keys = F.filter("keys", lambda k: F.instr(k, "/") > 0)
    longest = F.array_max(F.transform(rule_keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"))))
    chosen = found.withColumn("rule", longest["rule"])
    verdicts = F.create_map(*[F.lit(x) for pair in (rules or {"": ""}).items() for x in pair])
    method = F.when(F.exists("keys", lambda k: F.instr(k, "/") == 0), "block").otherwise("allow")
    return chosen.select("page_id", "url", "host", "path", "rule", F.coalesce(verdicts[F.col("rule")], method).alias("verdict"))
