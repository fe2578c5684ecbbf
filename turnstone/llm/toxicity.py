"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

Writers hide words by look-alike characters, separators or spaces between letters
and repeated letters.  Each token gives a lattice: every character as it is, as a
letter that it looks like, or dropped (separator or repetition), at a channel cost.
Viterbi finds the cheapest path under a character trigram model counted over all
documents.  A token whose lattice has one path needs no search.  Spaces between single
characters and between pieces that together may be a telling word are kept or dropped
in the same lattice, so the model places the word borders.  Labels choose the words that
tell toxic rows and their weights; nothing but the text enters a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.llm.common import LOWER, give_back, held, labelled_texts, sampled_labels, slices, staged, texts
from turnstone.llm.linear import fit_sparse, sigmoid

#: Bound of the labelled sample.
TRAIN_ROWS = 20_000
#: A telling word stands in this many toxic rows, and by this log odds rather in them than in others.
MIN_TOXIC_ROWS = 3
MIN_ODDS = 1.0
#: It is sought in split writing too if chance alone would yield such a word among all words with this probability at most.
CHANCE = 0.01
THRESHOLD = 0.5
#: Training rows: crc32 of the id as text, modulo this, is not 0.
FOLDS = 5
REMEMBERED = 100_000

#: Letters that a character can stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
SEPARATORS = ".-_*~'`,:;/\\"
SUBSTITUTION_COST = 1.0
DROP_COST = 0.5
KEEP_COST = 8.0
#: Dropping one of a pair of equal letters, which many words have rightly.
PAIR_COST = 3.0

LETTERS, OTHER, EDGE, CODES = 26, 26, 27, 28
_CODE_OF_BYTE = np.full(256, EDGE, dtype=np.int64)
_CODE_OF_BYTE[97:123] = np.arange(26)
_CODE_OF_BYTE[65:91] = np.arange(26)
_CODE_OF_BYTE[192:] = OTHER
_EDGES = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_LEADING = _EDGES.replace(b"@", b"").replace(b"$", b"")
_PLAIN = re.compile(rb"[a-z\x80-\xff]*\Z")
_PAIR = re.compile(rb"([a-z])\1")
#: Letters and look-alikes that may be read alike have one key, repeated ones once.
_ALIKE = bytes.maketrans(b"013456789@$!|+l", b"oieasgtbgasiiti")
#: Bytes that neither are nor stand for a letter a-z.
_MARKS = bytes(b for b in range(256) if not 97 <= _ALIKE[b] <= 122)
_MARKS_IN_LINE = _MARKS.replace(b"\n", b"")
#: Marks that stand for a letter.
_LETTER_MARKS = b"@$!|+"
_REPEATED = re.compile(rb"([a-z])\1+")
_LETTER = re.compile(rb"[a-z]")
_SPACED = re.compile(rb"(?<![^ \t\n\r])(?:[a-z0-9@$!|+][ \t.*_-]{1,3}){2,}[a-z0-9@$!|+](?![^ \t\n\r.,!?;:])")


def character_counts(documents: DataFrame) -> np.ndarray:
    """Trigram counts of letters, other characters and word edges over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES**3, dtype=np.int64)
        for part in slices(batches, "text"):
            data = np.frombuffer(b"\n\n".join([b"", *texts(part, "text"), b""]), dtype=np.uint8)
            code = _CODE_OF_BYTE[data[(data < 0x80) | (data >= 0xC0)]]
            if len(code) > 2:
                total += np.bincount((code[:-2] * CODES + code[1:-1]) * CODES + code[2:], minlength=CODES**3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["code", "n"])

    out = np.zeros(CODES**3)
    for row in documents.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[row.code] = row.n
    return out


class CharacterModel:
    """Costs (negative logs) of a character code after two others."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(CODES, CODES, CODES)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + CODES)
        p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
        p3 = (three + 20 * p2[None]) / (three.sum(2, keepdims=True) + 20)
        self.cost = -np.log(p3)


def _choices(token: str) -> list[list[tuple[str, float]]]:
    """For each character the letters it may stand for (empty: dropped) and their channel costs."""
    out, before = [], ""
    for at, char in enumerate(token):
        own = [(char, 0.0 if char.isalpha() else KEEP_COST)]
        own += [(letter, SUBSTITUTION_COST) for letter in LOOKALIKES.get(char, "")]
        if char == before:
            own.append(("", DROP_COST if char == token[at - 2 : at - 1] or char == token[at + 1 : at + 2] else PAIR_COST))
        elif char in SEPARATORS:
            own.append(("", DROP_COST))
        out.append(own)
        before = char
    return out


def _code(char: str) -> int:
    return ord(char) - 97 if "a" <= char <= "z" else OTHER if char.isalpha() else EDGE


def decode(token: str, model: CharacterModel) -> str:
    """The cheapest reading of a token; of equally cheap ones the first in order of choices."""
    return _cheapest(_choices(token), model)


def decode_pieces(pieces: list[str], drop_cost: float, model: CharacterModel) -> list[str]:
    """The words of the cheapest reading of pieces, each space between them kept or dropped."""
    lattice = _choices("".join(pieces))
    at = 0
    for number, piece in enumerate(pieces[:-1]):
        at += len(piece)
        lattice.insert(at + number, [(" ", 0.0), ("", drop_cost)])
    return _cheapest(lattice, model).split()


def _cheapest(lattice: list[list[tuple[str, float]]], model: CharacterModel) -> str:
    cost = model.cost
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
    for choices in lattice:
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (spent, trail) in paths.items():
            for char, price in choices:
                if char:
                    c = _code(char)
                    state, total, trail_now = (b, c), spent + price + cost[a, b, c], (char, trail)
                else:
                    state, total, trail_now = (a, b), spent + price, trail
                if state not in step or total < step[state][0]:
                    step[state] = (total, trail_now)
        paths = step
    _, trail = min(((spent + cost[a, b, EDGE], trail) for (a, b), (spent, trail) in paths.items()), key=lambda x: x[0])
    out = []
    while trail:
        char, trail = trail
        out.append(char)
    return "".join(reversed(out))


def core_of(token: bytes) -> bytes:
    """A lower-cased token without the punctuation at its ends."""
    core = token.rstrip(_EDGES).lstrip(_LEADING)
    if core[:1] in b"@$" and not _LETTER.match(core[1:2]):
        core = core.lstrip(_EDGES)
    return core


def restore(core: bytes, model: CharacterModel) -> str:
    """A token's core without its disguise."""
    if (_PLAIN.match(core) and not _PAIR.search(core)) or not _LETTER.search(core):
        return core.decode("utf-8", "replace")
    return decode(core.decode("utf-8", "replace"), model)


def features(word: str) -> tuple[str, ...]:
    """What a restored word is judged by: itself, and the beginning of a long one."""
    return (word, word[:6] + "*") if len(word) > 6 else (word,) if len(word) > 1 else ()


def spaced_words(text: bytes) -> list[bytes]:
    """Runs of three or more single characters, joined to a word each."""
    return [re.sub(rb"[ \t.*_-]+", b"", m.group()) for m in _SPACED.finditer(text)]


def alike(text: bytes) -> bytes:
    """What disguised and plain writings of a word have in common."""
    return _REPEATED.sub(rb"\1", text.translate(_ALIKE))


def skeleton(text: bytes) -> bytes:
    """The letters of ``alike`` alone: every reading of a token has the token's skeleton."""
    return _REPEATED.sub(rb"\1", text.translate(_ALIKE, _MARKS))


class Reader:
    """Distinct features of texts; tokens and what became of them are remembered."""

    def __init__(self, model: CharacterModel, known: dict[str, int] | None = None, sure: frozenset[str] = frozenset()):
        self.model, self.known, self.seen = model, known, {}
        words = [f.encode() for f in known or ()]
        split = [f.encode() for f in sorted(sure)]
        self.whole = frozenset(alike(w) for w in split if not w.endswith(b"*"))
        self.begun = frozenset(alike(w[:-1]) for w in split if w.endswith(b"*"))
        telling = self.whole | self.begun
        self.prefixes = frozenset(w[:n] for w in telling for n in range(1, len(w) + 1))
        #: What a telling word may begin with (letters and digits only) before its last piece.
        self.openings = frozenset(w[:n] for w in telling for n in range(1, len(w)) if w[:n].isalnum())
        self.opens: dict[bytes, bytes] = {}
        self.bones = frozenset(skeleton(w) for w in words if not w.endswith(b"*"))
        self.first_bones = frozenset(skeleton(w[:-1]) for w in words if w.endswith(b"*"))
        self.bone_sizes = sorted({len(w) for w in self.first_bones})

    def _may_tell(self, core: bytes) -> bool:
        """Whether some reading of the core can be a telling word."""
        letters = skeleton(core)
        if letters in self.bones:
            return True
        for size in self.bone_sizes:
            if letters[:size] in self.first_bones:
                return True
        return False

    def _read(self, token: bytes) -> tuple:
        found, core = (), b"" if b" " in token else core_of(token)
        if not core or self.known is None or self._may_tell(core):
            if b" " in token:
                pieces = token.decode("utf-8", "replace").split()
                read = decode_pieces(pieces, 0.0 if max(map(len, pieces)) == 1 else DROP_COST, self.model)
            else:
                read = [restore(core, self.model)]
                if _PAIR.search(token) and _PLAIN.match(core):
                    read.append(core.decode("utf-8", "replace"))  # a pair may be right
            found = tuple({f: None for word in read for f in features(word)})
            if self.known is not None:
                found = tuple(self.known[f] for f in found if f in self.known)
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        self.seen[token] = found
        return found

    def _learn(self, tokens: list[bytes]) -> None:
        """Remember of many tokens at once with what a telling word may begin, and those that can tell nothing."""
        joined = b"\n".join(tokens)
        keys = _REPEATED.sub(rb"\1", joined.translate(_ALIKE)).split(b"\n")
        bones = _REPEATED.sub(rb"\1", joined.translate(_ALIKE, _MARKS_IN_LINE)).split(b"\n")
        if len(self.opens) + len(tokens) > REMEMBERED:
            self.opens.clear()
            self.seen.clear()
        openings, opens, seen, whole, begun, sizes = self.openings, self.opens, self.seen, self.bones, self.first_bones, self.bone_sizes
        for token, key, letters in zip(tokens, keys, bones):
            if token[0] in _LEADING:
                key = alike(token.lstrip(_LEADING))
            opens[token] = key if key in openings else b""
            if token[0] in _LETTER_MARKS or token[-1] in _LETTER_MARKS:
                continue  # such marks are stripped, or letters: the token is read on its own
            if letters not in whole:
                for size in sizes:
                    if letters[:size] in begun:
                        break
                else:
                    seen[token] = ()

    def _split_words(self, tokens: list[bytes], distinct: set[bytes]) -> Iterator[bytes]:
        """Neighbouring pieces that a telling word can be split into, a space between each two.

        Pieces are joined as long as some telling word begins with them.
        """
        prefixes, begun, opens = self.prefixes, self.begun, self.opens
        openers = {token for token in distinct if opens[token]}
        for at in [i for i, token in enumerate(tokens[:-1]) if token in openers]:
            joined = opens[tokens[at]]
            for end in range(at + 1, len(tokens)):
                token = tokens[end]
                first = _ALIKE[token[0] : token[0] + 1]
                if first != joined[-1:] and joined + first not in prefixes:
                    break
                key = alike(token)
                rest = key[1:] if joined[-1:] == key[:1] else key
                one = joined + rest[:1]
                if rest and joined + rest[:2] not in prefixes and one not in begun and one not in self.whole:
                    break
                last = token.rstrip(_EDGES)  # a mark at the end may be a letter or close the word
                for piece in (token, last) if len(last) < len(token) else (token,):
                    own = key if piece is token else alike(piece)
                    whole = joined + (own[1:] if joined[-1:] == own[:1] else own)
                    size = len(joined)
                    while size < len(whole) and whole[: size + 1] in prefixes and whole[: size + 1] not in begun:
                        size += 1
                    if whole in self.whole or size < len(whole) and whole[: size + 1] in begun:
                        yield b" ".join([tokens[at].lstrip(_LEADING), *tokens[at + 1 : end], piece])
                joined += rest
                if joined not in self.openings:
                    break

    def features(self, text: bytes) -> set:
        text = text.translate(LOWER)
        ordered = text.split()
        distinct = set(ordered)
        if self.known is not None:
            new = [t for t in distinct if t not in self.opens]
            if new:
                if len(self.opens) + len(new) > REMEMBERED:
                    new = list(distinct)
                self._learn(new)
        tokens = set(distinct)
        spaced = spaced_words(text)
        tokens.update(spaced)
        tokens.update(b" ".join(x[i : i + 1] for i in range(len(x))) for x in spaced)
        if self.openings:
            tokens.update(self._split_words(ordered, distinct))
        seen, out = self.seen, set()
        for token in tokens:
            found = seen.get(token)
            if found is None:
                found = self._read(token)
            if found:
                out.update(found)
        return out


@dataclass(frozen=True)
class Model:
    """Character model, words with weights, those of them sought in split writing, bias."""

    name: str
    characters: CharacterModel
    known: dict[str, int]
    sure: frozenset[str]
    weights: np.ndarray
    bias: float


def _reader(model: Model) -> Reader:
    """One reader for each worker and model, so that tokens stay known between tasks."""
    return held(model.name, lambda: Reader(model.characters, model.known, model.sure))


def _toxic_words(sample: DataFrame, characters: CharacterModel) -> DataFrame:
    """``feature, toxic, rows``: in how many toxic and other sampled rows each feature occurs."""
    shared = sample.sparkSession.sparkContext.broadcast(characters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, toxic, rows = Reader(shared.value), Counter(), Counter()
        for part in slices(batches, "text"):
            for label, text in zip(part.column("label").to_pylist(), texts(part, "text")):
                found = reader.features(text)
                rows.update(found)
                if label:
                    toxic.update(found)
        names = sorted(rows)
        for at in range(0, len(names), 50_000):
            cut = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cut, pa.string()), pa.array([toxic[n] for n in cut], pa.int64()), pa.array([rows[n] for n in cut], pa.int64())],
                ["feature", "toxic", "rows"])

    counted = sample.select("label", "text").mapInArrow(run, "feature string, toxic long, rows long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows"))


def _ratio(all_rows: int, all_toxic: int) -> Column:
    """Likelihood ratio statistic of a word's rows against toxic rows."""
    word, toxic = F.col("rows"), F.col("toxic")
    cells = [
        (toxic, word * F.lit(all_toxic / all_rows)), (word - toxic, word * F.lit(1 - all_toxic / all_rows)),
        (F.lit(all_toxic) - toxic, (F.lit(all_rows) - word) * F.lit(all_toxic / all_rows)),
        (F.lit(all_rows - all_toxic) - word + toxic, (F.lit(all_rows) - word) * F.lit(1 - all_toxic / all_rows)),
    ]
    return 2 * sum((F.when((seen > 0) & (fair > 0), seen * F.log(seen / fair)).otherwise(0.0) for seen, fair in cells), F.lit(0.0))


def _sample_rows(sample: DataFrame, model: Model) -> DataFrame:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(shared.value)
        for part in slices(batches, "text"):
            found = [np.array(sorted(reader.features(t)), dtype="<i4").tobytes() for t in texts(part, "text")]
            yield pa.RecordBatch.from_arrays([part.column("label").cast(pa.int32()), pa.array(found, pa.binary())], ["label", "found"])

    return sample.select("label", "text").mapInArrow(run, "label int, found binary")


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, keep=None) -> Model:
    """Fit on the sampled labelled rows for which ``keep`` (a condition on ``doc_id``) holds.

    Without labels, or with one class only, every text gets the same score.
    """
    characters = CharacterModel(character_counts(documents))
    sample = labelled_texts(documents, sampled_labels(labels, "toxic", rows, keep))
    totals = sample.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    all_rows, all_toxic = max(totals.n, 1), totals.toxic or 0
    odds = F.log((F.col("toxic") + 0.5) / (all_toxic + 1)) - F.log((F.col("rows") - F.col("toxic") + 0.5) / (all_rows - all_toxic + 1))
    counted = staged(_toxic_words(sample, characters), "toxic-words")
    surprise = 2 * math.log(max(counted.count(), 1) / CHANCE)
    telling = counted.where((F.col("toxic") >= MIN_TOXIC_ROWS) & (odds > MIN_ODDS)).orderBy("feature")
    words = telling.select("feature", (_ratio(all_rows, all_toxic) > surprise).alias("sure")).collect()  # of at most ``rows`` texts
    known = {r.feature: i for i, r in enumerate(words)}
    sure = frozenset(r.feature for r in words if r.sure)
    name = xxhash.xxh64_hexdigest(repr((sorted(known), float(characters.cost.sum()))))
    blank = Model(name, characters, known, sure, np.zeros(len(known)), 0.0)
    got = sorted((r.label, r.found) for r in _sample_rows(sample, blank).collect())  # bounded by ``rows``
    found = [np.frombuffer(x, "<i4") for _, x in got]
    label = np.array([y for y, _ in got], dtype=np.float64)
    if not known or not 0 < label.sum() < len(label):
        return Model(name, characters, known, sure, np.zeros(len(known)), math.log((label.sum() + 1) / (len(label) - label.sum() + 1)))
    weights, bias = fit_sparse([(i, np.ones(len(i))) for i in found], label, len(known), penalty=3e-4, steps=300, rate=0.1, balanced=False)
    return Model(name, characters, known, sure, weights, bias)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents, ``score`` and ``predicted``; they replace columns of these names.

    Null and empty texts get the score of a text without telling words.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    base = documents.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        reader = _reader(own)
        for part in slices(batches, "text"):
            z = [own.bias + sum(own.weights[i] for i in sorted(reader.features(t))) for t in texts(part, "text")]
            p = sigmoid(np.array(z, dtype=np.float64))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], [*part.schema.names, "score", "predicted"])
        give_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, score double, predicted int")
