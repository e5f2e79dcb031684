"""Chat formatting with typed content parts.

The content of a turn is a list of parts: text, image, audio or document. A visitor flattens them in order into text and
placeholders, and notes each attachment with the tokens its placeholder stands for. The template marks turns with control
strings; a control string inside a text gets an escape character after its first one, so it cannot be taken for a mark,
and reading takes that back. The loss mask covers the texts of the assistant.

Turns are formatted row by row. A conversation is the sequence of its formatted turns in order, each of them a row, so a
conversation of any length needs no more memory than a turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.words import small_batches

TURN, END = "<|turn|>", "<|end|>"
#: Strings with a meaning to this template or, as fixed values, to other common chat templates.
CONTROLS = (
    TURN, END, "<|image|>", "<|audio|>", "<|document|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
)
ESCAPE = "\\"
LOSS_ROLE = "assistant"
PARTS = "array<struct<kind: string, text: string, ref: string, width: long, height: long, seconds: double, pages: long>>"

_HIDE = re.compile("|".join(rf"{re.escape(c[0])}(?=\\*{re.escape(c[1:])})" for c in CONTROLS))
_SHOW = re.compile("|".join(rf"(?<={re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in CONTROLS))
_SHAPE = re.compile(rf"{re.escape(TURN)}([^\n]*)\n(.*)\n{re.escape(END)}\n", re.DOTALL)


def escape(text: str) -> str:
    return _HIDE.sub(lambda m: m.group() + ESCAPE, text)


def unescape(text: str) -> str:
    return _SHOW.sub("", text)


@dataclass
class Flattener:
    """Visits parts in order; ``pieces`` and ``attachments`` grow."""

    patch: int = 14
    audio_rate: float = 25.0
    page_tokens: int = 1024
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part['kind']}", None)
        if method is None:
            raise ValueError(f"unknown kind of part: {part['kind']}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self._attach(part, -(-(part["width"] or 0) // self.patch) * -(-(part["height"] or 0) // self.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, int(-(-(part["seconds"] or 0.0) * self.audio_rate // 1)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 0) * self.page_tokens)

    def _attach(self, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "tokens": max(1, tokens)})
        self.pieces.append(f"<|{part['kind']}|>")


def text_parts(text: Column) -> Column:
    """The content of a turn that is a text only."""
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "long"), ("height", "long"), ("seconds", "double"), ("pages", "long"))]
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), *empty)).cast(PARTS)


def _role_line(role: str | None) -> str:
    return escape((role or "").replace("%", "%25").replace("\n", "%0A"))


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """The formatted turn, the part of it under the loss mask (begin and end in characters), and its attachments."""
    flat = Flattener()
    for part in parts or ():
        flat.visit(part)
    head, body = f"{TURN}{_role_line(role)}\n", "".join(flat.pieces)
    begin, end = (len(head), len(head) + len(body)) if role == LOSS_ROLE else (0, 0)
    return f"{head}{body}\n{END}\n", begin, end, flat.attachments


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text (with placeholders) of a formatted turn."""
    found = _SHAPE.fullmatch(formatted)
    if found is None:
        raise ValueError("not a formatted turn")
    role, body = found.groups()
    return unescape(role).replace("%0A", "\n").replace("%25", "%"), unescape(body)


ATTACHMENTS = "array<struct<kind: string, ref: string, tokens: long>>"


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted turns of rows ``conv_id, turn, role, parts``.

    Returns ``conv_id, turn, formatted, loss_begin, loss_end, attachments, attachment_tokens``. Nulls of content and role
    are empty; null conversation ids are one conversation, null turns come first; turns of equal number are ordered by
    what they say. Other columns are not carried. An empty table gives no rows.
    """
    kind = turns.schema["turn"].dataType.simpleString()
    attachment_type = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, parts = batch.column("role").to_pylist(), batch.column("parts").to_pylist()
            rows = [format_turn(role, content) for role, content in zip(roles, parts)]
            texts, begins, ends, attached = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(texts, pa.string()), pa.array(begins, pa.int64()),
                 pa.array(ends, pa.int64()), pa.array(attached, attachment_type),
                 pa.array([sum(x["tokens"] for x in a) for a in attached], pa.int64())],
                names=["conv_id", "turn", "formatted", "loss_begin", "loss_end", "attachments", "attachment_tokens"],
            )

    chosen = turns.select(F.col("conv_id").cast("long"), "turn", "role", "parts")
    return chosen.mapInArrow(
        formatted,
        f"conv_id long, turn {kind}, formatted string, loss_begin long, loss_end long, attachments {ATTACHMENTS}, attachment_tokens long",
    )


@dataclass
class _Reading:
    """Running digests of a conversation."""

    n_turns: int = 0
    loss_chars: int = 0
    formatted_chars: int = 0
    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)

    def add(self, formatted: str, begin: int, end: int) -> None:
        role, text = parse_turn(formatted)
        masked = unescape(formatted[begin:end])
        self.n_turns += 1
        self.formatted_chars += len(formatted)
        self.loss_chars += len(masked)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.loss.update(masked.encode("utf-8", "surrogatepass"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What formatted conversations say: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Turns stream through in order; only digests of one conversation are kept.
    """
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        rows: list[tuple] = []

        def close() -> None:
            if current is not None:
                conv, r = current
                rows.append((conv, r.n_turns, r.turns.hexdigest(), r.loss_chars, r.loss.hexdigest(), r.formatted_chars))

        def take() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            values = list(zip(*rows)) if rows else [()] * 6
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=columns)

        for batch in small_batches(batches, "formatted"):
            for row in batch.to_pylist():
                if current is None or current[0] != row["conv_id"]:
                    close()
                    current = (row["conv_id"], _Reading())
                current[1].add(row["formatted"], row["loss_begin"], row["loss_end"])
            yield take()
        close()
        yield take()

    chosen = formatted.select("conv_id", "turn", "formatted", "loss_begin", "loss_end")
    ordered = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInArrow(
        digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
