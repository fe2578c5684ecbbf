"""Quality rules: fixed limits on counts, then a calibrated n-gram classifier.

The classifier averages weights of hashed word unigrams, word pairs and 4-byte
n-grams of the whole text.  It is fitted on a bounded sample of labelled rows (the
first ``TRAIN_ROWS`` in hash order), its probabilities are calibrated on rows of
that sample that the fit did not see, and every text is scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.common import labelled_texts, sampled_labels, slices, texts
from turnstone.llm.hashing import SPACES, hash_words
from turnstone.llm.linear import calibrate, fit_sparse, sigmoid

#: Bound of the labelled sample.
TRAIN_ROWS = 2000
BITS = 15
TABLE = 1 << BITS
FAMILIES = 3
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A document stays if the calibrated probability of good quality is this much at least.
KEEP_PROBABILITY = 0.35

SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def hashed_texts(part: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray]]:
    """Each text with the hashes of its words, case kept."""
    all_texts = texts(part, "text")
    hashes, counts = hash_words(all_texts)
    return zip(all_texts, np.split(hashes, np.cumsum(counts)[:-1]))


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words that occur twice or more, the first included."""
    size = len(hashes) - window + 1
    if size < 2:
        return 0
    rolled = np.zeros(size, dtype=np.uint64)
    for i in range(window):
        rolled = (rolled ^ hashes[i : i + size]) * _STEP
        rolled ^= rolled >> np.uint64(29)
    order = np.argsort(rolled, kind="stable")
    ranked = rolled[order]
    same = np.zeros(size, dtype=bool)
    equal = ranked[1:] == ranked[:-1]
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    if not same.any():
        return 0
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    edges[:size] += same
    edges[window : window + size] -= same
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def families(text: bytes, hashes: np.ndarray) -> list[np.ndarray]:
    """Feature numbers of all word unigrams, word pairs and 4-byte n-grams, repeats included."""
    shift = np.uint64(64 - BITS)
    pairs = (hashes[:-1] * _STEP) ^ hashes[1:] if len(hashes) > 1 else hashes[:0]
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    grams = data[:0]
    if len(data) >= 4:
        grams = (data[:-3] | data[1:-2] << np.uint32(8) | data[2:-1] << np.uint32(16) | data[3:] << np.uint32(24)) * np.uint32(0x9E3779B1)
    return [
        ((hashes * _MIX) >> shift).astype(np.int64),
        ((pairs * _MIX) >> shift).astype(np.int64) + TABLE,
        (grams >> np.uint32(32 - BITS)).astype(np.int64) + 2 * TABLE,
    ]


@dataclass(frozen=True)
class Model:
    """Feature weights, bias, and the calibration's slope and offset."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, text: bytes, hashes: np.ndarray) -> float:
        """Probability of good quality: the sum over families of the mean weight."""
        score = self.bias + sum(float(self.weights[f].mean()) for f in families(text, hashes) if f.size)
        return float(sigmoid(np.array(self.slope * score + self.offset)))


def _feature_rows(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            index, value = [], []
            for text, hashes in hashed_texts(part):
                each = [np.unique(f, return_counts=True) for f in families(text, hashes)]
                index.append(np.concatenate([i for i, _ in each]).astype("<i4").tobytes())
                value.append(np.concatenate([n / max(n.sum(), 1) for _, n in each]).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("label").cast(pa.int32()), pa.array(index, pa.binary()), pa.array(value, pa.binary())],
                ["doc_id", "label", "places", "value"])

    return sample.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, places binary, value binary")


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on four fifths of the sample, calibrate on the rest.

    No labels, or labels of one class only, give a model that keeps every document.
    """
    sample = labelled_texts(documents, sampled_labels(labels, "quality", rows))
    got = sorted(_feature_rows(sample).collect(), key=lambda r: (r.doc_id, r.label, r.places))  # bounded by ``rows``
    label = np.array([r.label for r in got], dtype=np.float64)
    data = [(np.frombuffer(r.places, "<i4"), np.frombuffer(r.value, "<f4")) for r in got]
    if not got or label.min() == label.max():
        return Model(np.zeros(FAMILIES * TABLE, dtype=np.float32), 0.0, 1.0, 35.0)
    aside = np.array([xxhash.xxh64_intdigest(str(r.doc_id), 5) % 5 == 0 for r in got])
    if len(set(label[~aside])) < 2 or len(set(label[aside])) < 2:
        aside[:] = False
    fit = np.flatnonzero(~aside)
    weights, bias = fit_sparse([data[i] for i in fit], label[fit], FAMILIES * TABLE, penalty=1e-6, steps=60, rate=1.0)
    score = np.array([bias + (weights[i] * v).sum() for i, v in data])
    judged = aside if aside.any() else ~aside
    slope, offset = calibrate(score[judged], label[judged])
    return Model(weights.astype(np.float32), bias, slope, offset)


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, probability double"


def measure(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents and the measures of the whole text; null counts as empty.

    A measure replaces a column of its name.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    added = [x.split()[0] for x in MEASURES.split(", ")]
    base = documents.select([c for c in documents.columns if c not in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for part in slices(batches, "text"):
            out = []
            for text, hashes in hashed_texts(part):
                out.append((
                    len(hashes),
                    len(text.translate(None, SPACES + CONTINUATION)),
                    len(text) - len(text.translate(None, SYMBOLS)),
                    duplicate_lines(text),
                    repeated_words(hashes),
                    judge.probability(text, hashes),
                ))
            columns = [pa.array(x, pa.float64() if name == "probability" else pa.int64()) for name, x in zip(added, zip(*out))]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *added])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, {MEASURES}")


def judge(documents: DataFrame, model: Model, keep: float = KEEP_PROBABILITY) -> DataFrame:
    """Measures with ``base_failed`` (fixed limits) and ``kept`` (limits held and probability reached)."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        measure(documents.drop("base_failed", "kept"), model)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("probability") >= keep))
    )
