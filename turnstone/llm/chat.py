"""Chat formatting: conversations merged into prefix trees, shared turns emitted once.

A turn is a node, named by a digest of its ancestors and itself.  Conversations
sorted by their paths of node names are the depth-first order of the trees: each
adds the turns beyond the prefix it shares with the one before.  Paths are sorted
by ranges, so a first turn that very many conversations share is dealt to many tasks; a
tree that lies on a border of ranges is emitted as one tree in each.

A row of the output is one run of new turns: its place in the tree, the position id
of its first character (positions count from the start of a conversation), and the
intervals of the tree that hold its ancestors, to which alone it may attend besides
itself.  Characters (code points) stand for tokens; all offsets count them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.common import slices, staged

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
LOSS_ROLE = "assistant"
#: Control strings of this template and of other common ones; a text never shows one unescaped.
CONTROL = ["<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]
_ESCAPE = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_UNESCAPE = re.compile(r"\\(\\?)")
_TURN = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.S)


def escape(text: str) -> str:
    """A backslash breaks each control string after its first character; backslashes double."""
    return _ESCAPE.sub(lambda m: "\\\\" if m.group() == "\\" else m.group() + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template, and where its escaped text lies in it."""
    head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


CONVERSATIONS = "conv_id long, path array<binary>, leaf binary, roles array<string>, texts array<string>"


def conversations(turns: DataFrame) -> DataFrame:
    """One row for each conversation, streamed from sorted turns.

    Turns are ordered by ``turn``, equal ones by role and text, null numbers first.
    Null texts and roles are empty; rows without an id are one conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            path, name = [], b""
            for role, text in zip(roles, texts_):
                mark = f"{len(role)}\0{role}{text}".encode()
                name = hashlib.blake2b(name + hashlib.blake2b(mark, digest_size=16).digest(), digest_size=16).digest()
                path.append(name)
            lists = [pa.array([path], pa.list_(pa.binary())), pa.array([name], pa.binary()), *(pa.array([x], pa.list_(pa.string())) for x in (roles, texts_))]
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), *lists], ["conv_id", "path", "leaf", "roles", "texts"])

        key, roles, texts_, begun = None, [], [], False
        for part in slices(batches, "text"):
            for conv, role, text in zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if begun and conv != key:
                    yield row()
                    roles, texts_ = [], []
                key, begun = conv, True
                roles.append(role or "")
                texts_.append(text or "")
        if begun:
            yield row()

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, CONVERSATIONS)


SPAN = "array<struct<start:long,stop:long>>"
TREES = f"tree_id long, run_no long, leaf binary, shared_turns int, start long, text string, position long, ancestors {SPAN}, loss {SPAN}"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.string(), pa.int64(), _SPAN, _SPAN]


def _spans(pairs: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "stop": b} for a, b in pairs]


def _cut(pieces: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The first ``length`` characters of a path that consists of pieces of the tree, joined where they touch."""
    out: list[tuple[int, int]] = []
    for start, stop in pieces:
        if length <= 0:
            break
        stop = min(stop, start + length)
        length -= stop - start
        if out and out[-1][1] == start:
            out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
    return out


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of new turns from conversations in the order of their paths."""
    here = TaskContext.get().partitionId()
    tree, run_no, size = -1, 0, 0
    before: list[bytes] = []
    ends: list[int] = []  # where each turn of the path ends, in characters of the conversation
    pieces: list[tuple[int, int]] = []  # where the path lies in the tree
    for batch in batches:
        out = []
        for path, leaf, roles, texts_ in zip(*(batch.column(i).to_pylist() for i in range(4))):
            shared = 0
            while shared < min(len(path), len(before)) and path[shared] == before[shared]:
                shared += 1
            if not shared:
                tree, run_no, size, pieces, ends = tree + 1, 0, 0, [], []
            position = ends[shared - 1] if shared else 0
            ancestors = _cut(pieces, position)
            text, loss, ends = [], [], ends[:shared]
            at, length = size, position
            for role, said in zip(roles[shared:], texts_[shared:]):
                turn, start, stop = format_turn(role, said)
                if role == LOSS_ROLE:
                    loss.append((at + start, at + stop))
                text.append(turn)
                at, length = at + len(turn), length + len(turn)
                ends.append(length)
            out.append((here << 32 | tree, run_no, leaf, shared, size, "".join(text), position, _spans(ancestors), _spans(loss)))
            pieces, before, size, run_no = [*ancestors, (size, at)], path, at, run_no + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], [x.split()[0] for x in TREES.split(", ")])


def trees(distinct: DataFrame) -> DataFrame:
    """Prefix trees of distinct conversations (``path, leaf, roles, texts``)."""
    ordered = distinct.select("path", "leaf", "roles", "texts").repartitionByRange("path").sortWithinPartitions("path")
    return ordered.mapInArrow(_emit, TREES)


READ = "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, formatted string"


def _within(spans: list[tuple[int, int]], pieces: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return [s for s in spans if any(a <= s[0] and s[1] <= b for a, b in pieces)]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from runs sorted by tree and number: ancestors' intervals of the tree, then the run itself."""
    tree, held, spans = None, [], []
    for batch in slices(batches, "text"):
        out = []
        for row in batch.to_pylist():
            if row["tree_id"] != tree:
                tree, held, spans = row["tree_id"], [], []
            wanted = [(p["start"], p["stop"]) for p in row["ancestors"]]
            kept = []
            for start, stop in wanted:
                for begin, text in held:
                    lo, hi = max(start, begin), min(stop, begin + len(text))
                    if lo < hi:
                        kept.append((lo, text[lo - begin : hi - begin]))
            spans = _within(spans, wanted) + [(p["start"], p["stop"]) for p in row["loss"]]
            held = [*kept, (row["start"], row["text"])]
            formatted = "".join(text for _, text in held)
            loss = [unescape(text[a - begin : b - begin]) for a, b in spans for begin, text in held if begin <= a and b <= begin + len(text)]
            turns, said = parse(formatted), "".join(loss)
            digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
            out.append((row["leaf"], len(turns), digest, len(said), hashlib.sha256(said.encode()).hexdigest(), len(formatted), formatted))
        if out:
            kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [x.split()[0] for x in READ.split(", ")])


def read_back(output: DataFrame) -> DataFrame:
    """Every distinct conversation from the trees: counts, digests and the formatted text."""
    return output.repartition("tree_id").sortWithinPartitions("tree_id", "run_no").mapInArrow(_read, READ)


def format_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trees, members): the tree runs, and ``conv_id, leaf`` of every conversation.

    Equal conversations have one run and as many members.  Only ``conv_id, turn,
    role`` and ``text`` are read.
    """
    every = staged(conversations(turns), "conversations")
    first = every.groupBy("leaf").agg(F.min("conv_id").alias("first")).select("leaf", F.col("first").alias("conv_id"))
    named = every.join(first.where("conv_id is not null"), ["leaf", "conv_id"], "left_semi")
    unnamed = every.where("conv_id is null").join(first.where("conv_id is null"), "leaf", "left_semi").select(named.columns)
    return staged(trees(named.unionByName(unnamed)), "trees"), every.select("conv_id", "leaf")
