"""Chat formatting: messages of typed parts become marked-up text with a loss mask, and can be read back.

A message has a role and an ordered list of parts: text, image, audio or document. A visitor walks the parts
and writes text as it is (escaped) and any other part as a placeholder; for each placeholder it records
which attachment it stands for, where it is and how many tokens the attachment expands to.

One message is ``<|im_start|>ROLE\\nCONTENT<|im_end|>\\n``. No text can forge a control string: a backslash in a text
becomes two, and ``<`` becomes ``\\l`` before ``|`` and at the end of a part, so ``<|`` stands in markup only. Roles also have
their line breaks escaped. ``read_back`` needs nothing but the formatted text and the loss spans.

Messages are formatted where they are read, one row each, so a conversation never has to fit into a row or
a task. Only digests of whole conversations need their messages in order: one shuffle by
conversation, sorted on disk, then streamed through running digests.

Edge cases: a null text is empty, a null role too; null ids are one conversation (id null); rows with equal turns
follow role, then formatted text (nulls first), null turns come first; repeated rows are turns of their own; no parts give an
empty message, null parts are left out; a part of an unknown kind raises an error; an attachment without its sizes expands
to one token; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, SEPARATOR = "<|im_start|>", "<|im_end|>\n", "\n"
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENT = "struct<kind: string, ref: string, place: bigint, tokens: bigint>"
FORMATTED = f"conv_id bigint, turn bigint, role string, formatted string, spans array<struct<start: bigint, stop: bigint>>, attachments array<{ATTACHMENT}>"
_OPENING = re.compile(r"<(?=\||\Z)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_MEANT = {"l": "<", "n": "\n"}


def escape(text: str) -> str:
    return _OPENING.sub(r"\\l", text.replace("\\", "\\\\"))


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _MEANT.get(m[1], m[1]), text) if "\\" in text else text


@dataclass(frozen=True)
class Expansion:
    """Tokens that an attachment takes in the model's input."""

    patch: int = 14
    tokens_a_second: int = 25
    tokens_a_page: int = 1024

    def image(self, part: dict) -> int:
        return max(1, -(-(part["width"] or 0) // self.patch) * -(-(part["height"] or 0) // self.patch))

    def audio(self, part: dict) -> int:
        return max(1, int(-(-(part["seconds"] or 0.0) * self.tokens_a_second // 1)))

    def document(self, part: dict) -> int:
        return max(1, (part["pages"] or 0) * self.tokens_a_page)


@dataclass
class Flattener:
    """Visits the parts of one message in order; ``at`` is the code point where the next part begins."""

    expansion: Expansion
    at: int
    trained: bool
    pieces: list[str] = field(default_factory=list)
    spans: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        visitor = getattr(self, f"visit_{part['kind']}", None)
        if visitor is None:
            raise ValueError(f"unknown kind of part: {part['kind']}")
        visitor(part)

    def visit_text(self, part: dict) -> None:
        written = escape(part["text"] or "")
        if self.trained and written:
            self.spans.append({"start": self.at, "stop": self.at + len(written)})
        self._write(written)

    def visit_image(self, part: dict) -> None:
        self._attach(part, self.expansion.image(part))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, self.expansion.audio(part))

    def visit_document(self, part: dict) -> None:
        self._attach(part, self.expansion.document(part))

    def _attach(self, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "place": self.at, "tokens": tokens})
        self._write(f"<|{part['kind']}|>")

    def _write(self, text: str) -> None:
        self.pieces.append(text)
        self.at += len(text)


def format_message(role: str, parts: list[dict], trained: bool, expansion: Expansion) -> tuple[str, list[dict], list[dict]]:
    """(text, loss spans, attachments); places are code points of the message."""
    head = f"{START}{escape_role(role)}{SEPARATOR}"
    visitor = Flattener(expansion, len(head), trained)
    for part in parts:
        if part is not None:
            visitor.visit(part)
    return head + "".join(visitor.pieces) + END, visitor.spans, visitor.attachments


def text_part(text: Column) -> Column:
    """The parts of a message that is nothing but a text."""
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *empty))


def format_messages(messages: DataFrame, trained: str = "assistant", expansion: Expansion = Expansion()) -> DataFrame:
    """One row per message (conv_id, turn, role, parts): its text, loss spans and attachments.

    Spans cover the texts of the role ``trained``, without markup and placeholders.
    """
    kinds = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("place", pa.int64()), ("tokens", pa.int64())])
    types = [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.list_(kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [
                format_message(role or "", parts or [], role == trained, expansion)
                for role, parts in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist(), strict=True)
            ]
            made = [pa.array([d[i] for d in done], t) for i, t in enumerate(types)]
            own = [batch.column(c) for c in ("conv_id", "turn", "role")]
            yield pa.RecordBatch.from_arrays([*own, *made], names=["conv_id", "turn", "role", "formatted", "spans", "attachments"])

    own = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("parts").cast(f"array<{PART}>").alias("parts"))
    return own.mapInArrow(run, FORMATTED)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, content still escaped) of the messages in a formatted text."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        line = formatted.index(SEPARATOR, at)
        stop = formatted.index(END, line)
        yield unescape(formatted[at + len(START):line]), formatted[line + 1:stop]
        at = stop + len(END)


@dataclass
class _Digest:
    """Running digests of one conversation."""

    turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    text: "hashlib._Hash" = field(default_factory=hashlib.sha256)
    loss: "hashlib._Hash" = field(default_factory=hashlib.sha256)

    def add(self, formatted: str, spans: list[dict]) -> None:
        self.chars += len(formatted)
        for role, content in read_turns(formatted):
            self.turns += 1
            self.text.update(f"{role}\n{unescape(content)}\n".encode())
        for span in spans:
            under = unescape(formatted[span["start"]:span["stop"]])
            self.loss_chars += len(under)
            self.loss.update(under.encode())


READ_BACK = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation of what ``format_messages`` wrote: turns as parsed, texts under the loss spans.

    Placeholders count as the text that stands for them.
    """
    names = [f.split()[0] for f in READ_BACK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        ready: list[list] = []

        def close() -> None:
            ready.append([current[0], digest.turns, digest.text.hexdigest(), digest.loss_chars, digest.loss.hexdigest(), digest.chars])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans")]
            for conv_id, text, spans in zip(*columns, strict=True):
                if current is None or current[0] != conv_id:
                    if current is not None:
                        close()
                    current, digest = (conv_id,), _Digest()
                digest.add(text, spans)
            if ready:
                yield _rows(ready, names)
                ready.clear()
        if current is not None:
            close()
            yield _rows(ready, names)

    order = ["conv_id", "turn", "role", "formatted"]
    dealt = formatted.select(*order, "spans").repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "formatted", "spans").mapInArrow(run, READ_BACK)


def _rows(rows: list[list], names: list[str]) -> pa.RecordBatch:
    types = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
