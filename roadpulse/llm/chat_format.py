"""Chat formatting: turns of a conversation become text segments with loss flags.

A declarative template names, per role, the marks around a turn and whether its
text bears loss. Marks that occur inside a text are escaped, reversibly: a
backslash is doubled, and one is put after the first character of a mark. A
finite-state machine over the roles checks the turn order. ``read_back`` parses
the formatted text again.

Rows are shuffled once by conversation and sorted by turn; tasks then stream
over them, so a conversation of any length needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, LongType, StringType, StructField,
                               StructType)

BATCH_ROWS, BATCH_CHARS = 4096, 4_000_000


@dataclass(frozen=True)
class Template:
    """``turns``: role -> (open mark, close mark, text bears loss). Other roles
    are written with ``other`` = (open mark, mark after the role, close mark).
    ``after``: state (None at the start) -> roles allowed next; ``final``:
    roles a conversation may end with."""

    turns: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("<s>", "</s>", True)})
    other: tuple = ("[ROLE]", "[TEXT]", "[/ROLE]")
    after: dict = field(default_factory=lambda: {
        None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple = ("assistant",)

    def marks(self) -> list[str]:
        return [m for a, b, _ in self.turns.values() for m in (a, b)] + list(self.other)


LLAMA = Template()


class Codec:
    """Writes and reads turns of one template."""

    def __init__(self, template: Template = LLAMA):
        self.t = template
        marks = sorted(template.marks(), key=len, reverse=True)
        if any("\\" in m or len(m) < 2 for m in marks):
            raise ValueError("marks have two characters or more and no backslash")
        self._special = re.compile("|".join(map(re.escape, ["\\", *marks])))
        self._escaped = re.compile(r"\\(\\?)")
        self._open = {m[0]: (role, m[1]) for role, m in template.turns.items()}

    def escape(self, text: str) -> str:
        return self._special.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[1], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(formatted text, loss) of a turn; empty texts give no segment."""
        if role in self.t.turns:
            start, end, loss = self.t.turns[role]
            parts = [(start, False), (self.escape(text), loss), (end, False)]
        else:
            a, b, c = self.t.other
            parts = [(a + self.escape(role) + b, False), (self.escape(text), False), (c, False)]
        return [p for p in parts if p[0]]

    def read_turn(self, formatted: str) -> tuple[str, str, int] | None:
        """Role, text and length of the turn that ``formatted`` starts with;
        None while it is not complete."""
        for start, (role, end) in self._open.items():
            if formatted.startswith(start):
                at = formatted.find(end, len(start))
                return None if at < 0 else (role, self.unescape(formatted[len(start):at]), at + len(end))
        a, b, c = self.t.other
        if formatted.startswith(a):
            mid = formatted.find(b, len(a))
            at = formatted.find(c, mid + len(b)) if mid >= 0 else -1
            return None if at < 0 else (self.unescape(formatted[len(a):mid]),
                                        self.unescape(formatted[mid + len(b):at]), at + len(c))
        if any(m.startswith(formatted) for m in (*self._open, a)):
            return None
        raise ValueError("the text does not start with a turn")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, chars: int | None) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded rows and characters (of column ``chars``)."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[chars]) if chars is not None else 0
        if len(held) >= BATCH_ROWS or size >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def format_chats(conversations: DataFrame, template: Template = LLAMA) -> DataFrame:
    """Segments of every conversation: ``conv_id``, ``seq`` (from 0), ``turn_no``
    (from 0), ``text`` (formatted), ``loss``, ``in_order`` (the role was
    allowed after the one before). Joined by ``seq`` the texts of a
    conversation are its formatted form.

    Turns go by ``turn`` (nulls first), ties by role, then text; repeated rows
    are turns of their own. A null role or text counts as empty, null ids form
    one conversation, and other columns are not read. A text of any length is
    one segment.
    """
    id_type = conversations.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", id_type), StructField("seq", LongType()),
                         StructField("turn_no", LongType()), StructField("text", StringType()),
                         StructField("loss", BooleanType()), StructField("in_order", BooleanType())])
    turns = (conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                  F.coalesce("text", F.lit("")).alias("text"))
             .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
             .select("conv_id", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template)
        out: pa.Schema | None = None

        def rows(first: pa.RecordBatch) -> Iterator[tuple]:
            conv, state, seq, turn = object(), None, 0, 0
            for c, role, text in _stream(_chain(first, batches)):
                if c != conv:
                    conv, state, seq, turn = c, None, 0, 0
                ok = role in template.after.get(state, ())
                for part, loss in codec.segments(role, text):
                    yield c, seq, turn, part, loss, ok
                    seq += 1
                state, turn = role, turn + 1

        for first in batches:
            out = pa.schema([("conv_id", first.schema.field(0).type), ("seq", pa.int64()), ("turn_no", pa.int64()),
                             ("text", pa.string()), ("loss", pa.bool_()), ("in_order", pa.bool_())])
            yield from _batched(rows(first), out, 3)

    return turns.mapInArrow(run, schema)


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def read_back(segments: DataFrame, template: Template = LLAMA, sorted_by_seq: bool = False) -> DataFrame:
    """Per conversation, parsed from the formatted text: ``n_turns``,
    ``turns_sha256`` (of role, newline, text, newline per turn),
    ``loss_chars`` and ``loss_sha256`` (unescaped text under the loss flags),
    ``formatted_chars``, ``n_bad_turns`` (not in order) and ``complete`` (ends
    with a final role). ``sorted_by_seq``: the segments come straight from
    ``format_chats``, whose tasks hold whole conversations in order."""
    id_type = segments.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", id_type), StructField("n_turns", LongType()),
                         StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()),
                         StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()),
                         StructField("n_bad_turns", LongType()), StructField("complete", BooleanType())])
    if not sorted_by_seq:
        segments = segments.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    read = segments.select("conv_id", "text", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template)

        class Conversation:
            def __init__(self):
                self.n = self.loss_chars = self.chars = self.bad = 0
                self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
                self.state, self.held = None, ""

            def add(self, text: str, loss: bool) -> None:
                self.chars += len(text)
                if loss:
                    plain = codec.unescape(text)
                    self.loss_chars += len(plain)
                    self.loss.update(plain.encode())
                self.held += text
                while self.held and (turn := codec.read_turn(self.held)):
                    role, plain, used = turn
                    self.held = self.held[used:]
                    self.turns.update(f"{role}\n{plain}\n".encode())
                    self.n += 1
                    self.bad += role not in template.after.get(self.state, ())
                    self.state = role

            def row(self, conv) -> tuple:
                if self.held:
                    raise ValueError("the text ends within a turn")
                return (conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                        self.bad, self.state in template.final)

        def rows(first: pa.RecordBatch) -> Iterator[tuple]:
            conv, held = None, None
            for c, text, loss in _stream(_chain(first, batches)):
                if held is None or c != conv:
                    if held is not None:
                        yield held.row(conv)
                    conv, held = c, Conversation()
                held.add(text, loss)
            if held is not None:
                yield held.row(conv)

        for first in batches:
            out = pa.schema([("conv_id", first.schema.field(0).type), ("n_turns", pa.int64()),
                             ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                             ("formatted_chars", pa.int64()), ("n_bad_turns", pa.int64()), ("complete", pa.bool_())])
            yield from _batched(rows(first), out, None)

    return read.mapInArrow(run, schema)
