"""Chat formatting: turns made of typed parts become template text with a loss mask.

A message's content is a list of parts: text, image, audio or document. A visitor walks over them
in order. Text is escaped and copied; the others leave a numbered placeholder in their place and
record an attachment: its number in the turn, its kind, its reference, and into how many tokens a
model would expand it.

The template opens a turn with ``<|im_start|>role`` and a line break and closes it with
``<|im_end|>`` and a line break. Control strings inside texts and roles are escaped so that they
can be read back: ``<``, any backslashes, ``|`` gets one backslash more. No escaped text contains
``<|``, so a reader finds turns and placeholders without knowing what was said.

Turns are formatted each by itself, so a conversation of any length is spread over all tasks.
Reading back streams over turns sorted by conversation and holds one turn at a time; a digest of a
whole conversation can only be taken in order, so that one step has a conversation in one task.

Defined results: null texts, roles and lists of parts are empty; a part of unknown type is an
error; turns with equal numbers are ordered by role and a hash of their parts, null turns come
first, and repeated rows are turns of their own; an empty table gives an empty result. Columns of the input that share
a name with a result are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from stratalake.llm.common import column_udf, prepare_workers, with_fields

# The template's control strings and the role whose text is learned.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"

# Expansion of attachments: pixels to a patch's side, tokens to a second, tokens to a page.
PATCH, SECOND_TOKENS, PAGE_TOKENS = 14, 25, 256

PARTS = (
    "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role ends at the line break, so its own line breaks are written as letters."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Flattener:
    """Visits the parts of a turn in order, building its text and its attachments."""

    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    said: str = ""

    def visit(self, part: dict) -> None:
        visitor = getattr(self, f"visit_{part['type']}", None)
        if visitor is None:
            raise ValueError(f"unknown type of part: {part['type']!r}")
        visitor(part)

    def visit_text(self, part: dict) -> None:
        # Escaped later, as two parts may meet in a control string that neither has.
        self.said += part["text"] or ""

    def visit_image(self, part: dict) -> None:
        across, down = -(-(part["width"] or 0) // PATCH), -(-(part["height"] or 0) // PATCH)
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part["seconds"] or 0.0) * SECOND_TOKENS))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part["pages"] or 0) * PAGE_TOKENS)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        number = len(self.attachments) + 1
        self.pieces += [escape(self.said), f"<|{kind}_{number}|>"]
        self.said = ""
        self.attachments.append({"number": number, "kind": kind, "ref": part["ref"], "tokens": tokens})

    @property
    def text(self) -> str:
        return "".join(self.pieces) + escape(self.said)


_ATTACHMENT = pa.struct(
    [("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]
)
_FIELDS = (
    "formatted string, loss_start int, loss_end int, "
    "attachments array<struct<number:int,kind:string,ref:string,tokens:long>>, attachment_tokens long"
)
_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.list_(_ATTACHMENT), pa.int64()]
_NAMES = ["formatted", "loss_start", "loss_end", "attachments", "attachment_tokens"]


def format_turn(role: str | None, parts: list[dict] | None) -> tuple:
    """One turn: its text, the range of it that is learned, and its attachments."""
    visitor = Flattener()
    for part in parts or ():
        visitor.visit(part)
    head = f"{TURN_START}{escape_role(role or '')}\n"
    body = visitor.text
    text = f"{head}{body}{TURN_END}\n"
    end = len(head) + len(body)
    start = len(head) if role == LEARNED_ROLE else end
    return text, start, end, visitor.attachments, sum(a["tokens"] for a in visitor.attachments)


def format_turns(messages: DataFrame, role_column: str = "role", parts_column: str = "parts") -> DataFrame:
    """The rows with ``formatted``, the learned range in it, and the attachments.

    A conversation's text is its rows' ``formatted`` in the order of ``turn_order``.
    """

    def step(rows: list) -> list:
        made = [format_turn(r["role"], r["parts"]) for r in rows]
        return [list(c) for c in zip(*made)] if made else [[] for _ in _NAMES]

    row = F.struct(F.col(role_column).cast("string").alias("role"), F.col(parts_column).cast(PARTS).alias("parts"))
    made = column_udf(messages.sparkSession, step, _FIELDS, _TYPES)
    return with_fields(messages, made(row), _NAMES)


def turn_order(turn_column: str = "turn", role_column: str = "role", parts_column: str = "parts") -> list:
    return [F.col(turn_column), F.col(role_column), F.xxhash64(parts_column)]


# --- reading back ------------------------------------------------------------------------------

_TURN = re.compile(
    re.escape(TURN_START) + r"(?P<role>[^\n]*)\n(?P<body>.*?)" + re.escape(TURN_END) + r"\n", re.DOTALL
)


class Reader:
    """Reads a conversation back from its formatted text, piece by piece."""

    def __init__(self) -> None:
        self.turns, self.turn_bytes = 0, hashlib.sha256()
        self.loss_chars, self.loss_bytes = 0, hashlib.sha256()
        self.chars, self.rest = 0, ""

    def feed(self, text: str, loss_start: int, loss_end: int) -> None:
        self.chars += len(text)
        learned = unescape(text[loss_start:loss_end])
        self.loss_chars += len(learned)
        self.loss_bytes.update(learned.encode("utf-8", "replace"))
        self.rest += text
        at = 0
        while found := _TURN.match(self.rest, at):
            self.turns += 1
            said = f"{unescape_role(found['role'])}\n{unescape(found['body'])}\n"
            self.turn_bytes.update(said.encode("utf-8", "replace"))
            at = found.end()
        self.rest = self.rest[at:]

    def row(self) -> tuple:
        if self.rest:
            raise ValueError("the text does not end with a whole turn")
        return self.turns, self.turn_bytes.hexdigest(), self.loss_chars, self.loss_bytes.hexdigest(), self.chars


def read_back(
    formatted: DataFrame,
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    parts_column: str = "parts",
) -> DataFrame:
    """Per conversation what a reader of its formatted text finds: turns and learned text."""
    prepare_workers(formatted.sparkSession)
    kind = formatted.schema[conversation_column].dataType
    schema = T.StructType(
        [
            T.StructField(conversation_column, kind),
            *T._parse_datatype_string(
                "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
            ).fields,
        ]
    )
    order = [f"__o{k}" for k in range(3)]
    rows = formatted.select(
        conversation_column,
        "formatted",
        "loss_start",
        "loss_end",
        *[c.alias(n) for c, n in zip(turn_order(turn_column, role_column, parts_column), order)],
    )
    streamed = (
        rows.repartition(F.col(conversation_column))
        .sortWithinPartitions(conversation_column, *order)
        .drop(*order)
    )

    names = schema.fieldNames()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, key_type = None, None, None
        for batch in batches:
            key_type, done = batch.schema.field(0).type, []
            for conversation, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if reader is None or conversation != current:
                    if reader is not None:
                        done.append((current, *reader.row()))
                    reader, current = Reader(), conversation
                reader.feed(text, start, end)
            if done:
                yield _batch(done, key_type, names)
        if reader is not None:
            yield _batch([(current, *reader.row())], key_type, names)

    return streamed.mapInArrow(read, schema)


def _batch(rows: list[tuple], key_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
