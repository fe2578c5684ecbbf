"""64-bit hashes of all words of a batch of texts in a few numpy passes.

A word's hash is the sum of a random number of each byte times a power of an odd
base, taken from running sums over the whole buffer and moved to offset zero with
the inverse power.  All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import numpy as np
import xxhash

SPACES = b" \t\n\x0b\x0c\r"
#: Longer words are hashed on their own; texts are cut between words into buffers of about this size.
LONG_WORD = 1 << 16
BUFFER = 5 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTES = _table(7)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the largest buffer seen."""
    if not _POWERS or len(_POWERS[0]) < size:
        up, down = np.full(size, _BASE, dtype=np.uint64), np.full(size, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS[0], _POWERS[1]


def separators(extra: bytes = b"") -> np.ndarray:
    """True for each byte that ends a word."""
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(SPACES + extra, dtype=np.uint8)] = True
    return out


WHITE = separators()


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of hashes."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def _buffer(data: bytes, fold: bool, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(data, dtype=np.uint8)
    gap = gaps[codes]
    turn = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(codes) and not gap[0]:
        turn = np.concatenate([[0], turn])
    if len(turn) % 2:
        turn = np.append(turn, len(codes))
    start, end = turn[0::2], turn[1::2]
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((_FOLDED if fold else _BYTES)[codes] * up[: len(codes)], out=sums[1:])
    value = mixed((sums[end] - sums[start]) * down[start])
    for i in np.flatnonzero(end - start > LONG_WORD):
        word = data[start[i] : end[i]]
        value[i] = xxhash.xxh64_intdigest(word.lower() if fold else word, 3)
    return value, start, end


def _pieces(data: bytes, gaps: np.ndarray):
    """Parts of a long text, cut before a gap: (offset, part)."""
    at = 0
    while len(data) - at > BUFFER:
        stop = at + BUFFER
        while stop < len(data):
            hits = np.flatnonzero(gaps[np.frombuffer(data, dtype=np.uint8, count=min(BUFFER, len(data) - stop), offset=stop)])
            if hits.size:
                stop += int(hits[0])
                break
            stop += min(BUFFER, len(data) - stop)
        yield at, data[at:stop]
        at = stop
    yield at, data[at:]


def hash_words(texts: list[bytes], fold: bool = False, gaps: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text.

    ``fold`` takes A-Z as a-z.  Words end at the bytes that ``gaps`` marks.
    """
    if sum(map(len, texts)) + len(texts) <= BUFFER:
        value, start, _ = _buffer(b"\n".join(texts), fold, gaps)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
        return value, np.diff(np.searchsorted(start, ends), prepend=0)
    if len(texts) > 1:
        half = len(texts) // 2
        (a, n), (b, m) = hash_words(texts[:half], fold, gaps), hash_words(texts[half:], fold, gaps)
        return np.concatenate([a, b]), np.concatenate([n, m])
    value = np.concatenate([_buffer(part, fold, gaps)[0] for _, part in _pieces(texts[0], gaps)])
    return value, np.array([len(value)])
