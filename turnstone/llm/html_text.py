"""Main text of web pages as a maximum-scoring subsequence of words and tags.

Words score by the container they stand in, tags by their name: log odds of being
inside the content, counted over the pages whose markup labels their content (an
``article`` or ``main`` element), with a prior by the container's name.  Tags never score
above zero.  One linear scan finds the contiguous run of tokens with the largest sum; its
text without the containers that score below zero is the result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.common import slices

#: Container and tag names that get weights of their own, the most frequent first.
MAX_NAMES = 5000
CLIP = 4.0
PRIOR_ROWS = 20.0
#: Score of a text in a container that doesn't belong to the article around it.
INSERTED = -0.05

#: Elements whose content is never text.
HIDDEN = ["script", "style", "noscript", "template", "iframe", "svg", "math", "object", "select", "textarea", "button", "head", "title"]
#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that are containers by their tag, and elements without content.
CONTAINERS = frozenset("article main nav header footer aside form body dialog menu figure".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a block's beginning closes.
IMPLIED = frozenset("p li dt dd td th tr h1 h2 h3 h4 h5 h6 option".split())
#: Words of class names and ids that tell what a container holds.
NOT_CONTENT = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus dialog footer form header"
    " login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted related reply"
    " replies respond responses search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
CONTENT = frozenset("article articlebody body content entry main post story text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
SKIPPED = frozenset(HIDDEN)


def container(name: str, rest: str) -> str | None:
    """The container that an opening tag begins: its tag and the words of its class, id and role."""
    words = {w for groups in _NAMED.findall(rest) for w in _WORD.findall(" ".join(groups).lower())} if "=" in rest else set()
    if name in CONTAINERS or words and name in BLOCKS:
        return ".".join([name, *sorted(words)])
    return None


@dataclass
class Weights:
    """Scores of a word in each container and of each tag."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def word(self, name: str) -> float:
        known = self.words.get(name)
        return known if known is not None else math.log(prior(name) / (1 - prior(name)))

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.2)


def prior(name: str) -> float:
    """How likely a word of a container is content, by the container's name alone."""
    tag, *words = name.split(".")
    if tag in ("nav", "header", "footer", "aside", "form", "menu", "dialog") or NOT_CONTENT & set(words):
        return 0.05
    return 0.9 if tag in ("article", "main") or CONTENT & set(words) else 0.6


@dataclass
class Token:
    """A tag or a run of text with the containers around it."""

    text: str | None
    tag: str
    inside: tuple[str, ...]


def tokens(page: str) -> Iterator[Token]:
    """Tags and texts in order.  Unclosed elements end with their parents; stray end tags are ignored."""
    stack: list[tuple[str, str | None]] = []
    inside: tuple[str, ...] = ()
    hidden = 0
    for match in _TOKEN.finditer(page):
        text, name = match["text"], match["name"]
        if text is not None:
            if not hidden:
                yield Token(text, "", inside)
            continue
        if match["raw"] is not None:
            yield Token(None, match["raw"].lower(), inside)
            continue
        if name is None:
            continue
        name = name.lower()
        if match["close"]:
            if any(n == name for n, _ in stack):
                while stack:
                    last, _ = stack.pop()
                    hidden -= last in SKIPPED
                    if last == name:
                        break
        else:
            rest = match["rest"]
            if name == "body":
                while stack and stack[-1][0] == "head":
                    stack.pop()
                    hidden -= 1
            if name in BLOCKS and stack and stack[-1][0] in IMPLIED and name not in ("td", "th", "tr", "table", "ul", "ol", "dl"):
                stack.pop()
            if name not in VOID and not rest.endswith("/"):
                own = container(name, rest)
                if own and own.startswith("header") and any(c.startswith(("article", "main")) for _, c in stack if c):
                    own = None  # the head of the article itself
                stack.append((name, own))
                hidden += name in SKIPPED
        inside = tuple(c for _, c in stack if c)
        yield Token(None, name, inside)


def _label(page: str) -> str | None:
    """The element that labels the content of a page."""
    lower = page.lower()
    return next((name for name in ("article", "main") if f"<{name}" in lower), None)


def _labelled_counts(pages: DataFrame) -> DataFrame:
    """``kind, name, content, other``: words by container and tags, within and outside the labelled element."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, other = Counter(), Counter()
        for part in slices(batches, "html"):
            for page in part.column("html").to_pylist():
                label = _label(page) if page else None
                if not label:
                    continue
                for token in tokens(page):
                    within = any(c.split(".")[0] == label for c in token.inside)
                    tally = content if within else other
                    if token.text is None:
                        tally["tag", token.tag] += 1
                    elif token.inside:
                        tally["word", token.inside[-1]] += len(token.text.split())
        names = sorted(content.keys() | other.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in names], pa.string()), pa.array([n for _, n in names], pa.string()),
             pa.array([content[n] for n in names], pa.int64()), pa.array([other[n] for n in names], pa.int64())],
            ["kind", "name", "content", "other"])

    counted = pages.select("html").mapInArrow(run, "kind string, name string, content long, other long")
    return counted.groupBy("kind", "name").agg(F.sum("content").alias("content"), F.sum("other").alias("other"))


def learn(pages: DataFrame) -> Weights:
    """Weights from all labelled pages; without any, the priors alone."""
    rows = _labelled_counts(pages).orderBy(F.desc(F.col("content") + F.col("other")), "kind", "name").limit(MAX_NAMES).collect()
    out = Weights()
    for kind in ("word", "tag"):
        own = [r for r in rows if r.kind == kind]
        for r in own:
            belief = prior(r.name) if kind == "word" else 0.5
            odds = math.log((r.content + PRIOR_ROWS * belief) / (r.other + PRIOR_ROWS * (1 - belief)))
            odds = max(-CLIP, min(CLIP, odds))
            if kind == "word":
                out.words[r.name] = odds
            else:
                out.tags[r.name] = min(-0.05, odds / CLIP)
    return out


def _score(token: Token, weights: Weights) -> float:
    if token.text is None:
        return weights.tag(token.tag)
    count = len(token.text.split())
    if not count:
        return 0.0
    own = [weights.word(c) for c in token.inside]
    if min(own, default=0.0) >= 0:
        return count * (own[-1] if own else 0.3)
    # Boilerplate within an article is left out but doesn't end the run.
    first = next(i for i, w in enumerate(own) if w < 0)
    within = any(c.split(".")[0] in ("article", "main") for c in token.inside[:first])
    return INSERTED if within else count * min(own)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and stop of the contiguous run with the largest sum; the first of equals, empty if none is positive."""
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def extract(page: str, weights: Weights) -> str:
    """The main text: blocks joined by a line feed, white space inside a block as one space."""
    found = list(tokens(page))
    scores = [_score(t, weights) for t in found]
    begin, end = best_run(scores)
    blocks, block = [], []
    for token, score in zip(found[begin:end], scores[begin:end]):
        if token.text is None:
            if token.tag in BLOCKS:
                blocks.append("".join(block))
                block = []
            elif token.tag == "br":
                block.append(" ")
        elif score >= 0:
            block.append(html.unescape(token.text))
    blocks.append("".join(block))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def main_text(pages: DataFrame, weights: Weights) -> DataFrame:
    """All columns of the pages and ``text`` (which replaces one of that name); null html gives the empty text."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    base = pages.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            out = [extract(page or "", shared.value) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*part.schema.names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, text string")
