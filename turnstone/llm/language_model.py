"""Log-bilinear language model: noise-contrastive training and normalised scores.

Words are mapped to classes: the most frequent words are classes of their own, all
others share classes by their last two bytes.  The model predicts a token's class
from the two classes before it; a word's share of its class is its smoothed count in
the whole training corpus, so the probabilities of all words and one unseen word of each class
sum to one.  Every task trains on its own texts from the same start (a short run over a
bounded sample breaks the symmetry) and the parameters are averaged by tokens, so
training reads all training texts.  Scores are exact: logits are batched matrix
products over all classes and each context's normaliser is kept once computed.

Counts of words are joined by their 64-bit hash.  The most frequent ``HEAD_WORDS`` at
most are broadcast; the rest stay in a table that rare tokens are joined with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.llm.common import list_array, slices, staged, texts
from turnstone.llm.hashing import WHITE, hash_words

#: Words that are classes of their own, classes for all other words, width of the vectors.
OWN_CLASSES = 640
TAIL_CLASSES = 64
WIDTH = 24
#: Words whose counts are broadcast (16 bytes each).
HEAD_WORDS = 2_000_000
#: Texts of the short first run.
START_TEXTS = 1500
MINIBATCH = 4096
NOISE = 128
RATE = 0.08
#: Hash of the token that ends a text; no word has it as words are never empty.
END_HASH = 0x5EED_0F_E4D
HELD_OUT_FOLDS, HELD_OUT = 7, 2
CLASSES = OWN_CLASSES + 1 + TAIL_CLASSES  # own words, end, tails
END_CLASS = OWN_CLASSES
BEGIN = CLASSES  # only ever a context
COUNT_CAP = 1 << 20


def _hashes_and_tails(all_texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, their tail classes (by the last two bytes), and words by text."""
    hashes, counts = hash_words(all_texts, True)
    data = np.frombuffer(b"\n".join(all_texts) + b"\n", dtype=np.uint8) if all_texts else np.zeros(0, np.uint8)
    gap = WHITE[data]
    ends = np.flatnonzero(~gap[:-1] & gap[1:])
    begins = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    if len(data) and not gap[0]:
        begins = np.concatenate([[0], begins])
    folded = data | np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    final = folded[ends].astype(np.int64)
    before = np.where(ends > begins, folded[ends - 1], 0).astype(np.int64)
    return hashes, OWN_CLASSES + 1 + (before * 31 + final * 17) % TAIL_CLASSES, counts


def _with_ends(values: np.ndarray, counts: np.ndarray, end) -> np.ndarray:
    """The values of each text followed by ``end``."""
    return np.insert(values, np.cumsum(counts), end)


COUNTS = "hash long, tail int, n long"


def word_counts(documents: DataFrame) -> DataFrame:
    """``hash, tail, n`` of every word and the end token, over all texts (null as empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 8 << 20):
            hashes, tails, counts = _hashes_and_tails(texts(part, "text"))
            hashes = np.append(hashes, np.uint64(END_HASH))
            tails = np.append(tails, END_CLASS)
            found, first, n = np.unique(hashes, return_index=True, return_counts=True)
            n[found == END_HASH] = len(counts)
            columns = [pa.array(found.view(np.int64)), pa.array(tails[first].astype(np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "tail", "n"])

    return documents.select("text").mapInArrow(run, COUNTS).groupBy("hash").agg(F.min("tail").alias("tail"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the head words by hash, totals, and the classes' masses."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    distinct: int
    mass: np.ndarray  # of each class: sum of (count + 1) and, for a tail class, 1 for an unseen word
    complete: bool

    @property
    def total(self) -> int:
        return self.tokens + self.distinct + 1

    def look_up(self, hashes: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0 if not among the head) and class of each token."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=np.int64), np.where(hashes == END_HASH, END_CLASS, tails)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        kinds = np.where(known & (self.classes[at] >= 0), self.classes[at], tails)
        return np.where(known, self.counts[at], 0), np.where(hashes == END_HASH, END_CLASS, kinds)


def _least_head_count(counts: DataFrame, bound: int) -> int:
    """The smallest count such that at most ``bound`` words have it or more."""
    by_count = counts.groupBy(F.least("n", F.lit(COUNT_CAP)).alias("n")).agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    seen = 0
    least = COUNT_CAP + 1
    for row in by_count.toLocalIterator():
        seen += row.words
        if seen > bound:
            break
        least = row.n
    return least


def vocabulary(counts: DataFrame, head: int = HEAD_WORDS) -> tuple[Vocabulary, DataFrame]:
    """The broadcast part of the counts, and the table of the rest (``hash, n``)."""
    totals = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    least = _least_head_count(counts, head)
    rows = counts.where(F.col("n") >= least).select("hash", "n").toArrow()  # at most ``head`` rows
    hashes, n = rows.column("hash").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    classes = np.full(len(hashes), -1, dtype=np.int64)
    words = np.flatnonzero(hashes != END_HASH)
    ranked = words[np.lexsort((hashes[words], -n[words]))][:OWN_CLASSES]
    classes[ranked] = np.arange(len(ranked))
    classes[hashes == END_HASH] = END_CLASS
    own = hashes[ranked].view(np.int64).tolist()
    mass = np.zeros(CLASSES)
    mass[: len(ranked)] = n[ranked] + 1
    mass[END_CLASS] = (n[hashes == END_HASH].sum() if len(n) else 0) + 1
    mass[END_CLASS + 1 :] = 1
    rest = counts.where(~F.col("hash").isin([*own, END_HASH]))
    for row in rest.groupBy("tail").agg(F.sum(F.col("n") + 1).alias("mass")).collect():
        mass[row.tail] += row.mass
    found = Vocabulary(hashes, n, classes, totals.tokens or 0, totals.distinct, mass, len(hashes) == totals.distinct)
    return found, counts.where(F.col("n") < least).select("hash", "n")


@dataclass(frozen=True)
class Model:
    """Class vectors as contexts (of the last and the last but one token) and as targets, and biases."""

    contexts: np.ndarray  # 2 x (CLASSES + 1) x WIDTH
    targets: np.ndarray  # CLASSES x WIDTH
    bias: np.ndarray

    @classmethod
    def start(cls, mass: np.ndarray) -> "Model":
        draw = np.random.default_rng(11)
        bias = np.log(np.maximum(mass, 1e-3) / max(mass.sum(), 1))
        return cls(draw.normal(0, 0.1, (2, CLASSES + 1, WIDTH)).astype(np.float32), draw.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32), bias.astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.contexts.ravel(), self.targets.ravel(), self.bias])

    @classmethod
    def unflat(cls, flat: np.ndarray) -> "Model":
        a, b = 2 * (CLASSES + 1) * WIDTH, CLASSES * WIDTH
        flat = flat.astype(np.float32)
        return cls(flat[:a].reshape(2, CLASSES + 1, WIDTH), flat[a : a + b].reshape(CLASSES, WIDTH), flat[a + b :])


def contexts_of(kinds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the last and the last but one token before each; ``BEGIN`` before a text."""
    one = np.concatenate([[BEGIN], kinds[:-1]]) if len(kinds) else kinds
    two = np.concatenate([[BEGIN, BEGIN], kinds[:-2]])[: len(kinds)]
    starts = np.cumsum(counts) - counts
    one[starts] = BEGIN
    two[starts] = BEGIN
    seconds = starts[counts > 1] + 1
    two[seconds] = BEGIN
    return one, two


class Trainer:
    """Noise-contrastive steps: a token against noise drawn from the classes' shares, Adagrad."""

    def __init__(self, model: Model, mass: np.ndarray, rate: float = RATE):
        self.contexts, self.targets, self.bias = model.contexts.copy(), model.targets.copy(), model.bias.copy()
        self.sums = [np.full(x.shape[:-1] + (1,) if x.ndim > 1 else x.shape, 1e-2, np.float32) for x in (self.contexts[0], self.contexts[1], self.targets, self.bias)]
        share = np.maximum(mass, 1e-3)
        self.share = share / share.sum()
        self.noise_log = np.log(NOISE * self.share).astype(np.float32)
        self.edges = np.cumsum(self.share)
        self.rate = rate
        self.tokens = 0

    def _apply(self, which: int, table: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
        """Adagrad over the rows that a step touched, their slopes summed."""
        used, place = np.unique(rows, return_inverse=True)
        total = np.zeros((len(used),) + slope.shape[1:], dtype=np.float32)
        if slope.ndim == 1:
            total = np.bincount(place, slope, len(used)).astype(np.float32)
            self.sums[which][used] += total**2
            table[used] -= self.rate * total / np.sqrt(self.sums[which][used])
        else:
            order = np.argsort(place, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(used)))[:-1]])
            total = np.add.reduceat(slope[order], cuts, axis=0)
            self.sums[which][used] += (total**2).mean(axis=1, keepdims=True)
            table[used] -= self.rate * total / np.sqrt(self.sums[which][used])

    def step(self, one: np.ndarray, two: np.ndarray, word: np.ndarray, seed: int) -> None:
        draw = np.random.default_rng(seed)
        noise = np.minimum(np.searchsorted(self.edges, draw.random(NOISE)), CLASSES - 1)
        guess = self.contexts[0][one] + self.contexts[1][two]
        good = (guess * self.targets[word]).sum(1) + self.bias[word] - self.noise_log[word]
        bad = guess @ self.targets[noise].T + self.bias[noise] - self.noise_log[noise]
        size = np.float32(1 / 32)
        e_good = -size / (1 + np.exp(np.clip(good, -30, 30)))
        e_bad = size / (1 + np.exp(-np.clip(bad, -30, 30)))
        slope_guess = e_good[:, None] * self.targets[word] + e_bad @ self.targets[noise]
        slope_noise = e_bad.T @ guess
        self._apply(2, self.targets, np.concatenate([word, noise]), np.concatenate([e_good[:, None] * guess, slope_noise]))
        self._apply(3, self.bias, np.concatenate([word, noise]), np.concatenate([e_good, e_bad.sum(0)]))
        self._apply(0, self.contexts[0], one, slope_guess)
        self._apply(1, self.contexts[1], two, slope_guess)
        self.tokens += len(word)

    def feed(self, kinds: np.ndarray, counts: np.ndarray) -> None:
        one, two = contexts_of(kinds, counts)
        shuffled = np.random.default_rng(len(kinds)).permutation(len(kinds))
        for at in range(0, len(kinds), MINIBATCH):
            own = shuffled[at : at + MINIBATCH]
            self.step(one[own], two[own], kinds[own], self.tokens)

    def model(self) -> Model:
        return Model(self.contexts, self.targets, self.bias)


def _average(documents: DataFrame, shared, begin, rate: float) -> Model | None:
    """Each task trains on its texts from the same start; the mean by tokens.

    Sums are merged in groups of about the square root of the number of tasks, so that
    neither a task nor the driver sees all models.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        trainer = Trainer(begin.value, own.mass, rate)
        for part in slices(batches, "text"):
            hashes, tails, counts = _hashes_and_tails(texts(part, "text"))
            hashes, tails = _with_ends(hashes, counts, np.uint64(END_HASH)), _with_ends(tails, counts, END_CLASS)
            trainer.feed(own.look_up(hashes, tails)[1], counts + 1)
        if trainer.tokens:
            flat = trainer.model().flat().astype(np.float64) * trainer.tokens
            yield pa.RecordBatch.from_arrays([pa.array([trainer.tokens], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["tokens", "flat"])

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, flat = 0, None
        for batch in rows:
            for n, part in zip(batch.column("tokens").to_pylist(), batch.column("flat").to_pylist()):
                values = np.frombuffer(part)
                total, flat = total + n, values.copy() if flat is None else flat + values
        if flat is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["tokens", "flat"])

    each = documents.select("text").mapInArrow(run, "tokens long, flat binary")
    groups = max(4, math.isqrt(each.rdd.getNumPartitions()))
    sums = each.repartition(groups).mapInArrow(merge, "tokens long, flat binary").collect()
    tokens = sum(r.tokens for r in sums)
    if not tokens:
        return None
    return Model.unflat(sum(np.frombuffer(r.flat) for r in sums) / tokens)


def train(documents: DataFrame, words: Vocabulary) -> Model:
    """Train on all given texts; without any, the classes' shares remain."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(words)
    model = Model.start(words.mass)
    rows = documents.select("doc_id", "text")
    few = rows.join(F.broadcast(rows.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(START_TEXTS)), "doc_id", "left_semi")
    model = _average(few.coalesce(1), shared, spark.sparkContext.broadcast(model), RATE) or model
    return _average(rows, shared, spark.sparkContext.broadcast(model), RATE / 4) or model


class Scorer:
    """Log10 probabilities of classes; the normaliser of a context is computed once by a worker."""

    def __init__(self, model: Model):
        self.model = model
        self.log_norm = np.full((CLASSES + 1) ** 2, np.nan, dtype=np.float64)

    def log10(self, one: np.ndarray, two: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        model = self.model
        code = one * (CLASSES + 1) + two
        fresh = np.unique(code)
        fresh = fresh[np.isnan(self.log_norm[fresh])]
        for at in range(0, len(fresh), 4096):
            own = fresh[at : at + 4096]
            guess = model.contexts[0][own // (CLASSES + 1)] + model.contexts[1][own % (CLASSES + 1)]
            logits = guess @ model.targets.T + model.bias
            top = logits.max(axis=1)
            self.log_norm[own] = top + np.log(np.exp(logits - top[:, None]).sum(axis=1, dtype=np.float64))
        out = np.empty(len(kinds))
        for at in range(0, len(kinds), 1 << 16):
            s = slice(at, at + (1 << 16))
            guess = model.contexts[0][one[s]] + model.contexts[1][two[s]]
            logit = np.einsum("ij,ij->i", guess, model.targets[kinds[s]], dtype=np.float64) + model.bias[kinds[s]]
            out[s] = logit - self.log_norm[code[s]]
        return out / math.log(10)


HEAD = "row long, n_tokens long, n_known long, base_score double, score double, rare array<bigint>, times array<int>"


def _head_scores(rows: DataFrame, words: Vocabulary, model: Model) -> DataFrame:
    """Scores of each text as if words beyond the head were unseen, and those words."""
    spark = rows.sparkSession
    shared, fitted = spark.sparkContext.broadcast(words), spark.sparkContext.broadcast(model)
    keep = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, scorer = shared.value, Scorer(fitted.value)
        log_total, log_mass = math.log10(own.total), np.log10(own.mass)
        for part in slices(batches, "text"):
            hashes, tails, counts = _hashes_and_tails(texts(part, "text"))
            hashes, tails = _with_ends(hashes, counts, np.uint64(END_HASH)), _with_ends(tails, counts, END_CLASS)
            counts = counts + 1
            seen, kinds = own.look_up(hashes, tails)
            share = np.log10(seen + 1.0)
            starts = np.cumsum(counts) - counts
            one, two = contexts_of(kinds, counts)
            model_log = scorer.log10(one, two, kinds) + np.where(kinds > END_CLASS, share - log_mass[kinds], 0.0)
            rare_of, rare, times = np.repeat(np.arange(len(counts)), counts), np.zeros(0, np.uint64), np.zeros(0, np.int64)
            sizes = np.zeros(len(counts), dtype=np.int64)
            if not own.complete:
                unknown = np.flatnonzero(seen == 0)
                pairs = np.zeros(len(unknown), dtype=[("row", np.int64), ("hash", np.uint64)])
                pairs["row"], pairs["hash"] = rare_of[unknown], hashes[unknown]
                found, times = np.unique(pairs, return_counts=True)
                rare, sizes = found["hash"], np.bincount(found["row"], minlength=len(counts))
            columns = [
                pa.array(counts), pa.array(np.add.reduceat((seen > 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(share - log_total, starts)), pa.array(np.add.reduceat(model_log, starts)),
                list_array(rare.view(np.int64), sizes, pa.int64()), list_array(times.astype(np.int32), sizes, pa.int32()),
            ]
            names = ["n_tokens", "n_known", "base_score", "score", "rare", "times"]
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), *columns], [*(f.name for f in keep), *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return rows.mapInArrow(run, f"{fields}, {HEAD.split(', ', 1)[1]}")


def score(documents: DataFrame, learn_from: Column, head: int = HEAD_WORDS) -> DataFrame:
    """``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Rows for which ``learn_from`` holds train counts and model.  Null and empty texts
    are the end token alone.  Repeated rows and null ids give a result row each.
    """
    rows = documents.select("doc_id", F.coalesce(learn_from, F.lit(False)).alias("learned"), "text")
    known = rows.where("learned")
    counts = staged(word_counts(known), "counts")
    words, rest = vocabulary(counts, head)
    model = train(known, words)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    scored = staged(_head_scores(numbered, words, model), "scores")
    if not words.complete:
        pairs = F.explode(F.arrays_zip("rare", "times")).alias("pair")
        tokens = scored.select("row", pairs).select("row", F.col("pair.rare").alias("hash"), F.col("pair.times").alias("times"))
        found = tokens.join(rest, "hash").groupBy("row").agg(
            F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("gain"))
        scored = scored.join(found, "row", "left").withColumns({
            "n_known": F.col("n_known") + F.coalesce("more", F.lit(0)),
            "base_score": F.col("base_score") + F.coalesce("gain", F.lit(0.0)),
            "score": F.col("score") + F.coalesce("gain", F.lit(0.0)),
        })
    return scored.select("doc_id", "learned", "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"), "base_score", "score")
