"""Runs of words that repeat with a period, by an online sparse diagonal recurrence.

Word ``i`` and its earlier occurrence ``i - q`` lie on diagonal ``q``.  Words are taken in
order: each lag at which the text repeats itself goes on with its match length, and a
diagonal that gets no further match ends and, if long enough, emits its run at once.

Only lags that can still matter become active.  A run of period ``q`` needs at least
``max(q, 12 - q)`` matches in a row, so a word looks for its earlier occurrences together
with the words after it: six for lags below twelve, then ``L`` words for lags from ``L`` to
``2 L`` (L = 12, 24, 48, ...).  Occurrences at most ``L / 2`` apart lie in one run of a
smaller period that divides their distance; their diagonal would have that run's own
ends, so such pairs are left out.  A text of one word repeated thus costs n log n.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnstone.llm.common import slices, texts

#: A run has this many words at least, and two periods.
LEAST_WORDS = 12
#: Words that must agree before a lag below ``LEAST_WORDS`` becomes active.
SEED_WORDS = LEAST_WORDS // 2
#: Pairs (word, lag) that are expanded at once.
PAIRS_AT_ONCE = 1 << 20


def _repeated(first: np.ndarray, second: np.ndarray, shift: int, size: int, ends: np.ndarray) -> np.ndarray:
    """A number for each stretch of ``size`` words that begins twice or more, -1 for the others.

    A stretch is a stretch of ``first`` and, ``shift`` words on, one of ``second``.
    """
    place = np.flatnonzero(first >= 0)
    place = place[place + size <= ends[place]]
    place = place[second[place + shift] >= 0]
    out = np.full(len(first), -1, dtype=np.int64)
    if place.size:
        tail = second[place + shift]
        _, number, times = np.unique(first[place] * (int(tail.max()) + 1) + tail, return_inverse=True, return_counts=True)
        again = times[number] > 1
        out[place[again]] = number[again]
    return out


class Grams:
    """Places of a batch of texts where equal stretches of ``size`` words of one text begin twice or more."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        """``words``: numbers, never equal in two texts; ``ends``: the end of the text of each word."""
        one = np.where(np.bincount(words)[words] > 1, words, -1)
        two = _repeated(one, one, 1, 2, ends)
        four = _repeated(two, two, 2, 4, ends)
        self.number, self.size, self.ends = _repeated(four, two, 4, SEED_WORDS, ends), SEED_WORDS, ends

    def double(self) -> None:
        """Go on to stretches of twice the length."""
        self.number = _repeated(self.number, self.number, self.size, 2 * self.size, self.ends)
        self.size *= 2

    def any(self) -> bool:
        return bool((self.number >= 0).any())

    def lags(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place, lag) of equal stretches, in bounded parts."""
        place = np.flatnonzero(self.number >= 0)
        if not place.size:
            return
        least, most = (1, LEAST_WORDS - 1) if self.size == SEED_WORDS else (self.size, 2 * self.size - 1)
        span = len(self.number) + most + 1
        key = np.sort(self.number[place] * span + place)
        spot, gram = key % span, key // span
        fresh = np.concatenate([[True], gram[1:] != gram[:-1]])
        low = np.searchsorted(key, key - most)
        low = np.maximum(low, np.flatnonzero(fresh)[np.cumsum(fresh) - 1])
        high = np.searchsorted(key, key - least, side="right")
        if least > 1:
            chain = fresh | (np.diff(spot, prepend=0) > self.size // 2)
            high = np.minimum(high, np.flatnonzero(chain)[np.cumsum(chain) - 1])
        many = np.maximum(high - low, 0)
        total, at = np.cumsum(many), 0
        while at < len(key):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
            own = many[at:stop]
            here = np.repeat(spot[at:stop], own)
            before = np.arange(len(here)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(low[at:stop], own)
            yield here, here - spot[before]
            at = stop


@lru_cache(maxsize=1 << 16)
def _seed(lag: int) -> int:
    """Words that must agree before the lag becomes active."""
    size = SEED_WORDS
    while lag >= 2 * size:
        size *= 2
    return size


class Diagonals:
    """Active lags and the place where each began to match; runs as they end."""

    def __init__(self, base: int):
        self.base, self.active, self.last = base, {}, -2
        self.runs: dict[tuple[int, int], int] = {}

    def word(self, place: int, lags: list[int]) -> None:
        """The lags at which the word and those after it repeat the text; places ascend."""
        if place != self.last + 1:
            self.close()
        begun = self.active.get
        now = {lag: begun(lag, place) for lag in lags}
        for lag in self.active.keys() - now.keys():
            self._end(lag, self.active[lag])
        self.active, self.last = now, place

    def close(self) -> None:
        for lag, begin in self.active.items():
            self._end(lag, begin)
        self.active = {}

    def found(self) -> list[tuple[int, int, int]]:
        """Start, length and period of all runs once the text has ended."""
        self.close()
        return sorted(((start, length, lag) for (start, length), lag in self.runs.items()), key=lambda run: (run[0], run[2]))

    def _end(self, lag: int, begin: int) -> None:
        matches = self.last - begin + _seed(lag)
        if matches >= lag and matches + lag >= LEAST_WORDS:
            stretch = (begin - lag - self.base, matches + lag)
            self.runs[stretch] = min(lag, self.runs.get(stretch, lag))  # of equal stretches the smallest period is the run's


def runs_of(each: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of all runs of each list of words, by start and period."""
    numbers, at = [], 0
    for own in each:
        known = dict(zip(dict.fromkeys(own), count(at)))
        at += len(known)
        numbers.append(np.fromiter(map(known.__getitem__, own), dtype=np.int64, count=len(own)))
    sizes = np.array([len(x) for x in numbers], dtype=np.int64)
    ends = np.cumsum(sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in each]
    if not sizes.sum():
        return out
    grams = Grams(np.concatenate(numbers), np.repeat(ends, sizes))
    found = []
    while grams.any():
        found += grams.lags()
        grams.double()
    if not sum(len(place) for place, _ in found):
        return out
    place, lag = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
    order = np.argsort(place, kind="stable")
    place, lag = place[order], lag[order].tolist()
    first = np.flatnonzero(np.diff(place, prepend=-1))
    spots = place[first]
    owner = np.searchsorted(ends, spots, side="right").tolist()
    current, table = -1, None
    for text, spot, lo, hi in zip(owner, spots.tolist(), first.tolist(), [*first[1:].tolist(), len(lag)]):
        if text != current:
            if table:
                out[current] = table.found()
            current, table = text, Diagonals(int(ends[text] - sizes[text]))
        table.word(spot, lag[lo:hi])
    out[current] = table.found()
    return out


def collapse(own: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of each run only its first period."""
    if runs:
        change = np.zeros(len(own) + 1, dtype=np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        own = [own[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(own)


def find_runs(documents: DataFrame) -> DataFrame:
    """All columns of the documents, ``runs`` (array of start, length, period) and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, told apart as written and numbered from 0.  Null and
    empty texts have no runs and an empty ``collapsed``.  Repeated rows and null ids give a
    result row each.  ``runs`` and ``collapsed`` replace columns of these names.
    """
    base = documents.drop("runs", "collapsed")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            each = [t.split() for t in texts(part, "text")]
            found = runs_of(each)
            flat = np.array([r for x in found for r in x], dtype=np.int64).reshape(-1, 3)
            offsets = np.zeros(len(found) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in found], out=offsets[1:])
            items = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(offsets), items).cast(kind)
            collapsed = pa.array([collapse(w, r) for w, r in zip(each, found)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, runs, collapsed], [*part.schema.names, "runs", "collapsed"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.schema.fields)
    return base.mapInArrow(run, fields + "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
