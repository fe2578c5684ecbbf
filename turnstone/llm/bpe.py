"""Byte-level BPE: texts to token ids and back.

A long text is cut into overlapping chunks, which tasks pre-tokenise in parallel.  A
chunk's first matches may start inside a true piece; but from any position where
both neighbours begin a piece, both see the same text and split it alike.  The first
such position in the overlap is the stitch: the left chunk owns the pieces before
it, the right one those from it on.  A text whose chunks share no such position (a
run longer than the overlap) is encoded in one step.  Each piece is merged on its own by rank.
Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from turnstone.llm.common import give_back, held, list_array, slices, staged

CHUNK = 1 << 16
OVERLAP = 1 << 10
#: A match that ends this near to a chunk's end may have been changed by the cut.
MARGIN = 8
#: Bytes of text whose pieces are held and looked up together.
TOGETHER = 1 << 18
#: Pieces in each of the two generations that a worker remembers.
REMEMBERED = 40_000
#: Pieces of up to so many bytes are merged side by side, longer ones each with a heap.
SCANNED = 32
#: Pieces that are merged side by side.
AT_ONCE = 1 << 12
#: Bits of a row number, of up to ``SCANNED`` + 1.
ROW_BITS = 6


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class Pairs:
    """The rank of each two symbols that join.

    Symbols are the ranks of tokens; bytes that are no token get numbers above them.  The joins
    of all tokens lie in an open-addressing table, so many pairs are looked up at once.
    """

    EMPTY = -1

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values(), default=-1) + 1
        self.nothing = self.none + 256
        symbols = {bytes([b]): self.none + b for b in range(256)} | ranks
        self.of_byte = np.array([symbols[bytes([b])] for b in range(256)], dtype=np.int64)
        get = symbols.get
        cuts = ((get(token[:at]), get(token[at:]), rank) for token, rank in ranks.items() for at in range(1, len(token)))
        joins = np.array([x for x in cuts if x[0] is not None and x[1] is not None], dtype=np.int64).reshape(-1, 3)
        bits = max(8, int(4 * len(joins)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, self.EMPTY, dtype=np.int64)
        self.rank = np.full(1 << bits, self.none, dtype=np.int32)
        self._place(self._name(joins[:, 0], joins[:, 1]), joins[:, 2])

    def _name(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left * (self.nothing + 1) + right

    def _slot(self, name: np.ndarray) -> np.ndarray:
        return ((name.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _place(self, name: np.ndarray, rank: np.ndarray) -> None:
        slot = self._slot(name)
        while len(name):
            free = self.key[slot] == self.EMPTY
            self.key[slot[free]] = name[free]
            here = self.key[slot] == name
            self.rank[slot[here]] = rank[here]
            name, rank, slot = name[~here], rank[~here], (slot[~here] + 1) & self.mask

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair joined, ``none`` where it is no token."""
        name = self._name(left, right)
        slot = self._slot(name)
        key = self.key[slot]
        same = key == name
        out = np.where(same, self.rank[slot], self.none).astype(np.int64)
        more = np.flatnonzero(~same & (key != self.EMPTY))
        while more.size:
            slot[more] = (slot[more] + 1) & self.mask
            key = self.key[slot[more]]
            same = key == name[more]
            out[more[same]] = self.rank[slot[more[same]]]
            more = more[~same & (key != self.EMPTY)]
        return out


def merge_all(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """Little-endian int32 ids of pieces of 1 to ``SCANNED`` bytes, merged side by side in groups of about equal length."""
    size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    order = np.argsort(size, kind="stable")
    out = [b""] * len(pieces)
    for at in range(0, len(order), AT_ONCE):
        some = order[at : at + AT_ONCE]
        ids, counts = _merge_group([pieces[i] for i in some.tolist()], size[some], pairs)
        ends = (4 * np.cumsum(counts)).tolist()
        for i, lo, hi in zip(some.tolist(), [0, *ends[:-1]], ends):
            out[i] = ids[lo:hi]
    return out


def _merge_group(pieces: list[bytes], size: np.ndarray, pairs: Pairs) -> tuple[bytes, np.ndarray]:
    """A column for each piece, a row for each byte and an empty row at both ends; a round merges one pair in every column.

    ``key`` holds the rank of the pair that begins in a row, and the row, so its minimum is the
    leftmost pair of lowest rank.  A merged pair stays in its left row; the right one is skipped from then on.
    """
    many, rows = len(pieces), int(size.max()) + 2
    columns = np.repeat(np.arange(many), size)
    at = np.arange(len(columns)) - np.repeat(np.cumsum(size) - size, size) + 1
    symbol = np.full(rows * many, pairs.nothing, dtype=np.int64)
    symbol[at * many + columns] = pairs.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    never = pairs.none << ROW_BITS
    first = np.repeat(np.arange(rows), many)
    after, before = first + 1, first - 1
    key = np.full(rows * many, never, dtype=np.int64)
    begins = slice(many, -2 * many)
    key[begins] = (pairs.ranks(symbol[begins], symbol[2 * many : -many]) << ROW_BITS) + first[begins]
    key, column = key.reshape(rows, many), np.arange(many)
    while True:
        best = key.min(axis=0)
        live = np.flatnonzero(best < never)
        if not live.size:
            break
        if 4 * live.size < 3 * len(column):
            key, column, best, live = key[:, live], column[live], best[live], np.arange(live.size)
        rank, row, base = best[live] >> ROW_BITS, best[live] & ((1 << ROW_BITS) - 1), column[live]
        here = row * many + base
        gone, left = after[here], before[here]
        right = after[gone * many + base]
        symbol[here] = rank
        symbol[gone * many + base] = pairs.nothing
        after[here] = right
        before[right * many + base] = row
        key[gone, live] = never
        key[row, live] = (pairs.ranks(rank, symbol[right * many + base]) << ROW_BITS) + row
        key[left, live] = (pairs.ranks(symbol[left * many + base], rank) << ROW_BITS) + left
    by_piece = symbol.reshape(rows, many).T
    there = by_piece != pairs.nothing
    ids = by_piece[there]
    if ids.size and ids.max() >= pairs.none:
        raise KeyError("a byte is not in the vocabulary")
    return ids.astype("<i4").tobytes(), there.sum(axis=1)


def _merge_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The pair of lowest rank merges first, the leftmost of equals; a heap of pairs over a linked list: n log n steps for a very long piece."""
    size = len(piece)
    after, before, end = list(range(1, size + 1)), list(range(-1, size - 1)), list(range(1, size + 1))
    heap = []
    for i in range(size - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    alive = [True] * size
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else size
        if j >= size or end[j] != stop:
            continue
        end[i], after[i], alive[j] = stop, after[j], False
        if after[i] < size:
            before[after[i]] = i
            rank = ranks.get(piece[i : end[after[i]]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[after[i]]))
        if before[i] >= 0:
            left = before[i]
            rank = ranks.get(piece[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop))
    out, i = [], 0
    while i < size:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class Encoder:
    """Pieces to little-endian int32 ids, remembered by piece.

    When a generation is full it becomes the older one, and the one before it is forgotten;
    a piece of the older one moves on when it is met again.
    """

    def __init__(self, ranks: dict[bytes, int], pairs: Pairs, pattern: str):
        self.ranks, self.pairs, self.pattern, self.seen, self.older = ranks, pairs, regex.compile(pattern), {}, {}

    def _learn(self, new: set[str]) -> None:
        """Ids of pieces that are not among ``seen``: of the older generation, of whole tokens, or merged, short ones all at once."""
        known = new & self.older.keys()
        self.seen.update(zip(known, map(self.older.get, known)))
        short, data = [], []
        for piece in new - known:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is None and len(raw) <= SCANNED:
                short.append(piece)
                data.append(raw)
            else:
                tokens = _merge_heap(raw, self.ranks) if whole is None else [whole]
                self.seen[piece] = struct.pack(f"<{len(tokens)}i", *tokens)
        self.seen.update(zip(short, merge_all(data, self.pairs)))

    def pieces(self, found: list[list[str]]) -> list[bytes]:
        """The ids of each list of pieces."""
        if len(self.seen) >= REMEMBERED:
            self.seen, self.older = {}, self.seen
        new = set().union(*found) - self.seen.keys()
        self._learn(new)
        get = self.seen.get
        ids = [b"".join(map(get, one)) for one in found]
        for piece in [p for p in new if len(p) >= 64]:
            del self.seen[piece]
        return ids

    def texts(self, texts: list[str]) -> list[bytes]:
        return self.pieces([self.pattern.findall(t) for t in texts])

    def spans(self, spans: list[tuple[str, int, int]]) -> list[bytes]:
        """Of each text, start and stop: pieces that begin in [start, stop); ``start`` must begin a piece."""
        found = []
        for text, start, stop in spans:
            one = []
            for match in self.pattern.finditer(text, start):
                if match.start() >= stop:
                    break
                one.append(match.group())
            found.append(one)
        return self.pieces(found)


class Vocabulary:
    """Broadcast ranks and the pattern, with a name by content."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], pattern: str):
        self.shared = spark.sparkContext.broadcast((ranks, Pairs(ranks)))  # a vocabulary file's content: bounded
        self.pattern = pattern
        self.name = xxhash.xxh128_hexdigest(b"\0".join([pattern.encode(), *sorted(ranks, key=ranks.get)]))

    def encoder(self) -> Encoder:
        """One encoder for each worker and vocabulary, so that pieces stay known between tasks."""
        return held(self.name, lambda: Encoder(*self.shared.value, self.pattern))


def _with_ids(part: pa.RecordBatch, drop: set[str], each: list[bytes]) -> pa.RecordBatch:
    keep = [c for c in part.schema.names if c not in drop]
    counts = np.fromiter((len(x) // 4 for x in each), dtype=np.int64, count=len(each))
    ids = list_array(np.frombuffer(b"".join(each), dtype="<i4"), counts, pa.int32())
    return pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), ids], [*keep, "ids"])


def _strings(part: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in part.column(column).to_pylist()]


def _whole(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``ids`` in place of ``text``, each text in one step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.encoder().texts
        for part in slices(batches, "text", TOGETHER):
            yield _with_ids(part, {"text"}, encode(_strings(part, "text")))
        give_back()

    keep = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text")
    return rows.mapInArrow(run, f"{keep}, ids array<int>")


def _chunks(longs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``digest, part, parts, base, text``: each chunk with the overlap into the next."""
    parts = F.greatest(F.lit(1), F.ceil((F.length("text") - overlap) / chunk)).cast("int")
    numbered = longs.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    base = F.col("part") * chunk
    cut = F.expr(f"substring(text, part * {chunk} + 1, IF(part = parts - 1, length(text), {chunk + overlap}))")
    return numbered.select("digest", "part", "parts", base.alias("base"), cut.alias("text"))


def _boundaries(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``head``: where pieces begin in the overlap with the chunk before; ``tail``: with the chunk after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        for part in slices(batches, "text"):
            heads, tails = [], []
            for base, text in zip(part.column("base").to_pylist(), _strings(part, "text")):
                starts = np.fromiter((m.start() for m in split.finditer(text)), dtype=np.int64)
                heads.append((starts[starts <= overlap] + base).tolist())
                tails.append((starts[(starts >= chunk) & (starts <= chunk + overlap - MARGIN)] + base).tolist())
            names = ["digest", "part", "parts", "head", "tail"]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names[:3]), pa.array(heads, kind), pa.array(tails, kind)], names)

    return chunks.mapInArrow(run, "digest string, part int, parts int, head array<bigint>, tail array<bigint>")


def _stitches(bounds: DataFrame) -> DataFrame:
    """``start, stop`` of the pieces that each chunk owns; ``lost`` where a stitch of its text is missing."""
    order = Window.partitionBy("digest").orderBy("part")
    last = F.col("part") == F.col("parts") - 1
    met = bounds.select("digest", "part", "parts", F.array_min(F.array_intersect("tail", F.lead("head").over(order))).alias("met"))
    cut = met.select(
        "digest", "part", F.coalesce(F.lag("met").over(order), F.lit(0)).alias("start"), F.col("met").alias("stop"),
        (F.col("met").isNull() & ~last).alias("gap"))
    lost = cut.where("gap").select("digest").distinct().withColumn("lost", F.lit(True))
    return cut.join(lost, "digest", "left").select("digest", "part", "start", "stop", F.coalesce("lost", F.lit(False)).alias("lost"))


def _spans(owned: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.encoder().spans
        for part in slices(batches, "text", TOGETHER):
            rows = zip(*(part.column(c).to_pylist() for c in ("base", "start", "stop")), _strings(part, "text"))
            own = [(text, start - base, len(text) if stop is None else stop - base) for base, start, stop, text in rows]
            yield _with_ids(part, {"text", "base", "start", "stop"}, encode(own))
        give_back()

    return owned.mapInArrow(run, "digest string, part int, ids array<int>")


def encode(
    documents: DataFrame, ranks: dict[bytes, int], pattern: str, id_column: str = "doc_id", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``<id_column>, ids`` (array of int) of every row; null and empty texts have no ids.

    Texts of up to a chunk and an overlap are one chunk.  Equal long texts are encoded
    once.  Repeated rows and null ids give a result row each; other columns are not read.
    """
    vocabulary = Vocabulary(documents.sparkSession, ranks, pattern)
    rows = documents.select(F.col(id_column), "text")
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk + overlap
    short = _whole(rows.where(~is_long), vocabulary)

    keyed = rows.where(is_long).withColumn("digest", F.sha2("text", 256))
    once = keyed.select("digest", "text").dropDuplicates(["digest"])
    pieces = _chunks(once, chunk, overlap)
    plan = staged(_stitches(_boundaries(pieces.repartition("digest", "part"), pattern, chunk, overlap)), "stitches")
    owned = pieces.join(plan.where("not lost"), ["digest", "part"]).select("digest", "part", "base", "start", "stop", "text")
    spans = _spans(owned, vocabulary)
    joined = spans.groupBy("digest").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "ids"))), lambda x: x["ids"])).alias("ids"))
    lost = plan.where("lost").select("digest").distinct()
    in_one = _whole(once.join(lost, "digest", "left_semi").select("digest", "text"), vocabulary)
    long = keyed.select(id_column, "digest").join(joined.unionByName(in_one), "digest").select(id_column, "ids")
    return short.unionByName(long)


class ByteTable:
    """The bytes of all tokens in one array; ids to bytes by offsets, without an object for each token."""

    def __init__(self, ranks: dict[bytes, int]):
        by_rank = sorted((rank, token) for token, rank in ranks.items())
        size = by_rank[-1][0] + 1 if by_rank else 0
        self.length = np.full(size, -1, dtype=np.int64)
        rank = np.array([r for r, _ in by_rank], dtype=np.int64)
        self.length[rank] = [len(t) for _, t in by_rank]
        self.start = np.zeros(size, dtype=np.int64)
        self.start[rank] = np.cumsum(self.length[rank]) - self.length[rank]
        self.data = np.frombuffer(b"".join(t for _, t in by_rank), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in order, and how many each id has."""
        if ids.size and (ids.min() < 0 or ids.max() >= len(self.length) or self.length[ids].min() < 0):
            raise KeyError("an id is not in the vocabulary")
        many = self.length[ids]
        ends = np.cumsum(many)
        where = np.repeat(self.start[ids] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
        return self.data[where], many


def decode(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The columns of ``tokens`` and ``decoded`` (binary): the bytes of ``ids``, concatenated.

    A null list gives null; an id that the vocabulary lacks is an error.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(ByteTable(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in _by_ids(batch):
                ids = part.column("ids")
                data, many = table.bytes_of(ids.flatten().to_numpy())
                sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(many)])[np.cumsum(sizes)].tolist()
                whole = data.tobytes()
                out = [whole[lo:hi] if ok else None for lo, hi, ok in zip([0, *ends[:-1]], ends, ids.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*part.schema.names, "decoded"])
        give_back()

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField("decoded", BinaryType())]))


def _by_ids(batch: pa.RecordBatch, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the lists of a piece hold about ``most`` ids."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False))
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        base, start = int(ends[stop - 1]), stop
