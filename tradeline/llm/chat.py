r"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them, in order,
into one string: texts as they are, attachments as numbered placeholders, with a record of each
attachment and the tokens that it expands to. A turn is written as

    ### role: content</turn>\n

Control strings inside roles and texts (``###``, ``</turn>``, placeholder openings, backslashes) get a
backslash before them, which reading takes away again, so any text comes back unchanged. The loss mask
covers the contents of assistant turns, without marks.

Turns are formatted row by row before any shuffle. Then the rows of a conversation are sorted by turn
and numbered in a stream that keeps only a running position; the formatted conversation is what its
rows give one behind the other. A conversation of any length is never held whole.

Cases: a null role, text or content is empty; a part of an unknown kind is a document; a null conv_id is a
conversation of its own; a null turn comes first; equal turn numbers are ordered by their formatted
string; repeated rows are turns of their own. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<kind: string, text: string, uri: string, width: int, height: int, seconds: double, pages: int>"

ATTACHMENTS = "array<struct<kind: string, uri: string, start: long, tokens: long>>"

_ESCAPED = re.compile(r"\\|###|</turn>|<(?=(?:image|audio|document):)")
_ESCAPED_ROLE = re.compile(_ESCAPED.pattern + r"|:|\n")
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_HEAD, _COLON, _END = "### ", ": ", "</turn>\n"

ASSISTANT = "assistant"


def escape(text: str, pattern: re.Pattern = _ESCAPED) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text) if "\\" in text else text


@dataclass
class PartVisitor:
    """Flattens the parts of one turn; positions are code points of the flattened content."""

    patch: int = 28
    tokens_per_second: float = 25.0
    tokens_per_page: int = 1024
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    size: int = 0

    def visit(self, part: dict) -> None:
        kind = part["kind"] if part["kind"] in ("text", "image", "audio") else "document"
        getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part: dict) -> None:
        self._add(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        wide, high = (math.ceil((part[side] or 0) / self.patch) for side in ("width", "height"))
        self._attach("image", part, wide * high)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part["seconds"] or 0) * self.tokens_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part["pages"] or 0) * self.tokens_per_page)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "uri": part["uri"], "start": self.size, "tokens": tokens})
        self._add(f"<{kind}:{len(self.attachments)}>")

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, int, int, list[dict]]:
    """The formatted turn, start and end of its content, attachments (positions in the turn)."""
    visitor = PartVisitor()
    for part in parts or []:
        if part is not None:
            visitor.visit(part)
    head = _HEAD + escape(role or "", _ESCAPED_ROLE) + _COLON
    for attachment in visitor.attachments:
        attachment["start"] += len(head)
    return head + "".join(visitor.pieces) + _END, len(head), len(head) + visitor.size, visitor.attachments


def _unescaped(text: str, mark: str, at: int) -> int:
    """The next place of ``mark`` that no backslash escapes; -1 without one."""
    while (at := text.find(mark, at)) >= 0:
        before = at
        while before and text[before - 1] == "\\":
            before -= 1
        if (at - before) % 2 == 0:
            return at
        at += 1
    return -1


def read_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, unescaped content, and bounds of the content of each turn of a formatted string."""
    out, at = [], 0
    while at < len(formatted):
        first = at + len(_HEAD)
        colon = _unescaped(formatted, _COLON[0], first) if formatted.startswith(_HEAD, at) else -1
        end = _unescaped(formatted, _END, colon + len(_COLON)) if formatted.startswith(_COLON, colon) and colon >= 0 else -1
        if end < 0:
            raise ValueError(f"no turn at {at}")
        low = colon + len(_COLON)
        out.append((unescape(formatted[first:colon]), unescape(formatted[low:end]), low, end))
        at = end + len(_END)
    return out


def plain_parts(text: Column) -> Column:
    """A plain text as content of one text part."""
    empty = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    nulls = (F.lit(None).cast(kind).alias(name) for name, kind in empty.items())
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *nulls))


def format_conversations(
    rows: DataFrame, content: Column | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role"
) -> DataFrame:
    """conv_id, position, formatted, start, loss_start, loss_end, attachments of every turn.

    ``content`` is a column of type array<``PART``>, by default the plain text of column ``text``.
    ``start`` is the turn's place in the formatted conversation, in code points; the loss mask
    (null outside assistant turns) and the attachments' places are counted from there too. The rows of
    a conversation lie in one partition, in order.
    """
    parts = plain_parts(F.col("text")) if content is None else content
    rows = rows.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).alias("role"), parts.cast(f"array<{PART}>").alias("parts"),
    )

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch.column("role").to_pylist()
            done = [format_turn(role, p.as_py()) for role, p in zip(roles, batch.column("parts"), strict=True)]
            text, first, last, attached = zip(*done, strict=True) if done else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array(text, pa.string()),
                    pa.array([r == ASSISTANT for r in roles], pa.bool_()),
                    pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(attached, _attachments()),
                ],
                ["conv_id", "turn", "formatted", "learned", "first", "last", "attachments"],
            )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, position, start = object(), 0, 0
        for batch in batches:
            positions, starts = [], []
            for conv_id, text in zip(batch.column("conv_id").to_pylist(), batch.column("formatted"), strict=True):
                if conv_id != conversation:
                    conversation, position, start = conv_id, 0, 0
                positions.append(position)
                starts.append(start)
                position += 1
                start += len(text.as_py())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(positions, pa.int64()), pa.array(starts, pa.int64())],
                [*batch.schema.names, "position", "start"],
            )

    plain = f"conv_id long, turn long, formatted string, learned boolean, first long, last long, attachments {ATTACHMENTS}"
    formatted = rows.mapInArrow(turns, plain).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    numbered = formatted.mapInArrow(number, f"{plain}, position long, start long")
    return numbered.select(
        "conv_id", "position", "formatted", "start",
        F.expr("if(learned, start + first, null)").alias("loss_start"),
        F.expr("if(learned, start + last, null)").alias("loss_end"),
        F.expr("transform(attachments, a -> struct(a.kind, a.uri, a.start + start as start, a.tokens))").alias("attachments"),
    )


def _attachments() -> pa.DataType:
    fields = [("kind", pa.string()), ("uri", pa.string()), ("start", pa.int64()), ("tokens", pa.int64())]
    return pa.list_(pa.struct([pa.field(*f) for f in fields]))


def digests(formatted: DataFrame) -> DataFrame:
    """What ``format_conversations`` wrote, read back: counts and digests of every conversation.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of each turn), loss_chars and
    loss_sha256 (unescaped text under the loss mask), formatted_chars.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list | None = None  # conv_id, turns, digest, characters under the mask, their digest, all characters

        def closed(rows: list[list]) -> pa.RecordBatch:
            plain = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]] for r in rows]
            columns = zip(*plain, strict=True) if plain else ((),) * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "start", "loss_start", "loss_end"))
            for conv_id, start, low, high, text in zip(*columns, batch.column("formatted"), strict=True):
                if open_ is None or conv_id != open_[0]:
                    if open_ is not None:
                        done.append(open_)
                    open_ = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                segment = text.as_py()
                for role, content, _, _ in read_turns(segment):
                    open_[1] += 1
                    open_[2].update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
                if low is not None:
                    learned = unescape(segment[low - start : high - start])
                    open_[3] += len(learned)
                    open_[4].update(learned.encode("utf-8", "surrogatepass"))
                open_[5] += len(segment)
            if done:
                yield closed(done)
        if open_ is not None:
            yield closed([open_])

    rows = formatted.select("conv_id", "start", "loss_start", "loss_end", "formatted")
    return rows.mapInArrow(read, schema)
