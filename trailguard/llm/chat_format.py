"""Chat formatting of turns whose content is a list of typed parts.

A visitor goes through a turn's parts in order: text is escaped and appended, an image, audio clip
or document becomes a placeholder, and its reference, place and expanded token count are recorded.
A turn's formatted text is its role and content between the template's marks; a
conversation's is that of its turns one after the other.

Texts and roles may hold the marks themselves or other control strings.  Each occurrence gets one
more BREAK after its first character (one already broken gets another), so formatted text holds
no control string that the template did not write, and taking one BREAK away again restores every text.

Cases: a null text or list of parts is empty; a null role is an empty role; a part of unknown type is
its text, if it has one; null sizes count as the defaults of ``Expansion``; a null conv_id is a
conversation of its own; turns sort by (turn, role, parts), nulls first, so that repeated turns and
ties have a defined order and repeated rows stay; an empty table gives an empty result.

A conversation may be of any length: range partitions by (conv_id, turn) cut long conversations, turns
are formatted and read back one by one, and only what a checksum needs in sequence goes on as bounded pieces,
streamed by one task a conversation (SHA-256 can't be computed out of order).
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailguard.llm.common import prepare
from trailguard.session import materialize

BREAK = "\u2060"
#: Control strings of common chat templates.  Fixed values.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>", "<|system|>",
           "<|user|>", "<|assistant|>", "<|eot_id|>", "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>")
PIECE = 1 << 20


@dataclass(frozen=True)
class Template:
    start: str = "<|im_start|>"
    content: str = "<|im_content|>"
    end: str = "<|im_end|>\n"
    image: str = "<|image|>"
    audio: str = "<|audio|>"
    document: str = "<|document|>"
    trained: str = "assistant"
    foreign: tuple[str, ...] = FOREIGN

    def __post_init__(self):
        marks = self.controls
        for a in marks:
            if len(a) < 2 or BREAK in a or any(a != b and a in b for b in marks):
                raise ValueError(f"control string {a!r} is too short, holds the break or lies in another")
            if any(a.endswith(b[:n]) for b in marks for n in range(1, min(len(a), len(b)))):
                raise ValueError(f"control string {a!r} ends as another begins")

    @cached_property
    def controls(self) -> tuple[str, ...]:
        own = (self.start, self.content, self.end.rstrip("\n"), self.image, self.audio, self.document)
        return tuple(dict.fromkeys(own + self.foreign))

    @cached_property
    def pattern(self) -> str:
        """A control string's first character, its breaks, its rest; also for SQL."""
        return "|".join(f"{re.escape(c[0])}{BREAK}*{re.escape(c[1:])}" for c in self.controls)

    @cached_property
    def _control(self) -> re.Pattern:
        return re.compile(self.pattern)

    @cached_property
    def placeholders(self) -> dict[str, str]:
        return {self.image: "image", self.audio: "audio", self.document: "document"}

    @cached_property
    def _placeholder(self) -> re.Pattern:
        return re.compile("(" + "|".join(map(re.escape, self.placeholders)) + ")")

    def escape(self, text: str) -> str:
        return self._control.sub(lambda m: m[0][0] + BREAK + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._control.sub(lambda m: m[0][0] + m[0][2 if m[0][1] == BREAK else 1:], text)

    def pieces(self, content: str) -> list[str]:
        """Content cut at its placeholders, which stay."""
        return self._placeholder.split(content)


@dataclass(frozen=True)
class Expansion:
    """How many tokens a placeholder stands for: one per image patch, per stretch of audio, per share of a page."""
    patch: int = 28
    image_default: int = 256
    audio_per_second: float = 25.0
    audio_default: int = 25
    document_per_page: int = 512
    document_default: int = 512


class Visitor:
    """Flattens the parts of one turn."""

    def __init__(self, template: Template, expansion: Expansion, at: int, trained: bool):
        self.template, self.expansion, self.at, self.trained = template, expansion, at, trained
        self.out: list[str] = []
        self.loss: list[dict] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_text)(part)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.at += len(text)

    def visit_text(self, part: dict) -> None:
        text = self.template.escape(part.get("text") or "")
        if self.trained and text:
            self.loss.append({"start": self.at, "end": self.at + len(text)})
        self._put(text)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "at": self.at, "tokens": tokens})
        self._put(getattr(self.template, kind))

    def visit_image(self, part: dict) -> None:
        w, h, e = part.get("width"), part.get("height"), self.expansion
        self._attach("image", part, e.image_default if not w or not h else -(-w // e.patch) * -(-h // e.patch))

    def visit_audio(self, part: dict) -> None:
        s, e = part.get("seconds"), self.expansion
        known = s is not None and math.isfinite(s)
        self._attach("audio", part, math.ceil(max(s, 0) * e.audio_per_second) if known else e.audio_default)

    def visit_document(self, part: dict) -> None:
        n, e = part.get("pages"), self.expansion
        self._attach("document", part, e.document_default if n is None else n * e.document_per_page)


PARTS = "array<struct<type string, text string, ref string, width int, height int, seconds double, pages int>>"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ATTACHED = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))


def text_part(column: str = "text"):
    """A column of plain texts as lists of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.col(column).alias("text"))).cast(
        "array<struct<type string, text string>>")


def format_turns(turns: DataFrame, template: Template = Template(), expansion: Expansion = Expansion()) -> DataFrame:
    """``turns`` has conv_id, turn, role and parts (a list of structs with type and any of text, ref,
    width, height, seconds, pages).  Per turn: conv_id, turn, formatted, loss (spans of code
    points in formatted), attachments (kind, ref, place, tokens), placeholder_tokens."""
    prepare(turns.sparkSession)

    def flatten(batches):
        for b in batches:
            out = []
            for role, parts in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                head = template.start + template.escape(role or "") + template.content
                v = Visitor(template, expansion, len(head), role == template.trained)
                for part in parts or ():
                    if part is not None:
                        v.visit(part)
                out.append((head + "".join(v.out) + template.end, v.loss, v.attachments, sum(a["tokens"] for a in v.attachments)))
            text, loss, attached, tokens = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(loss, _LOSS),
                 pa.array(attached, _ATTACHED), pa.array(tokens, pa.int64())],
                names=["conv_id", "turn", "formatted", "loss", "attachments", "placeholder_tokens"])

    src = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                       "role", "parts")
    return src.mapInArrow(flatten, "conv_id bigint, turn bigint, formatted string, loss array<struct<start bigint, end bigint>>, "
                          "attachments array<struct<kind string, ref string, at bigint, tokens bigint>>, placeholder_tokens bigint")


def read_turn(template: Template, formatted: str, attachments: list | None = None) -> tuple[str, list[dict]]:
    """(role, parts) of one formatted turn: the inverse of formatting, but for empty text parts and neighbouring ones."""
    if not formatted.startswith(template.start) or not formatted.endswith(template.end):
        raise ValueError("not a formatted turn")
    role, _, content = formatted[len(template.start): -len(template.end)].partition(template.content)
    marks = template.placeholders
    left, parts = list(attachments or ()), []
    for piece in template.pieces(content):
        if piece in marks:
            ref = left.pop(0)["ref"] if left else None
            parts.append({"type": marks[piece], "ref": ref})
        elif piece:
            parts.append({"type": "text", "text": template.unescape(piece)})
    return template.unescape(role), parts


_PIECE_DDL = ("conv_id bigint, part bigint, piece bigint, n_turns bigint, loss_chars bigint, formatted_chars bigint, "
              "turns_sha256 string, loss_sha256 string, turns binary, loss binary")
_PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("n_turns", pa.int64()),
                     ("loss_chars", pa.int64()), ("formatted_chars", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_sha256", pa.string()), ("turns", pa.binary()), ("loss", pa.binary())])
_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _sha(data) -> str:
    return hashlib.sha256(data).hexdigest()


def _read_back(template: Template):
    """Reads a sorted partition of formatted turns: conversations that lie in it whole and are short
    give their checksums, others the bytes to be hashed, in pieces of about PIECE bytes."""

    def read(batches):
        part, out = TaskContext.get().partitionId(), []
        held = None             # [conv_id, piece, turns, loss chars, formatted chars, bytes of turns, bytes of loss]
        first = True

        def flush(conv, whole):
            row = [conv[0], part, conv[1], conv[2], conv[3], conv[4]]
            turns, loss = bytes(conv[5]), bytes(conv[6])
            out.append((*row, _sha(turns), _sha(loss), None, None) if whole else (*row, None, None, turns, loss))

        def emit():
            return pa.Table.from_pylist([dict(zip(_PIECES.names, r)) for r in out], _PIECES).to_batches()

        for b in batches:
            for conv_id, formatted, loss in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if held is None or held[0] != conv_id:
                    if held is not None:
                        flush(held, whole=not first and held[1] == 0)
                        first = False
                    held = [conv_id, 0, 0, 0, 0, bytearray(), bytearray()]
                role, parts = read_turn(template, formatted)
                text = "".join(p["text"] if p["type"] == "text" else getattr(template, p["type"]) for p in parts)
                under = "".join(template.unescape(formatted[s["start"]: s["end"]]) for s in loss or ())
                held[2] += 1
                held[3] += len(under)
                held[4] += len(formatted)
                held[5] += f"{role}\n{text}\n".encode()
                held[6] += under.encode()
                if len(held[5]) + len(held[6]) > PIECE:
                    flush(held, whole=False)
                    held = [conv_id, held[1] + 1, 0, 0, 0, bytearray(), bytearray()]
            if out:
                yield from emit()
                out.clear()
        if held is not None:
            flush(held, whole=False)
            yield from emit()

    return read


def _finish(batches):
    """Checksums of conversations in pieces, read in order; only running hashes are held."""
    now, out = None, []

    def row():
        return (now[0], now[1], now[4].hexdigest(), now[2], now[5].hexdigest(), now[3])

    for b in batches:
        for r in b.to_pylist():
            if now is None or now[0] != r["conv_id"]:
                if now is not None:
                    out.append(row())
                now = [r["conv_id"], 0, 0, 0, hashlib.sha256(), hashlib.sha256()]
            for i, c in enumerate(("n_turns", "loss_chars", "formatted_chars"), 1):
                now[i] += r[c]
            now[4].update(r["turns"])
            now[5].update(r["loss"])
    if now is not None:
        out.append(row())
    cols = list(zip(*out)) if out else [()] * len(_DIGEST)
    yield pa.RecordBatch.from_arrays([pa.array(c, _PIECES.field(n).type) for c, n in zip(cols, _DIGEST)], names=_DIGEST)


def in_order(turns: DataFrame) -> DataFrame:
    """Turns dealt and sorted by (conv_id, turn, role, parts); formatting keeps that order."""
    order = ["conv_id", "turn", "role", "parts"]
    return turns.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)


def read_conversations(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Reads :func:`format_turns` of turns :func:`in_order` back.  Per conversation: conv_id, n_turns, turns_sha256 (of role, line feed, text,
    line feed of each turn), loss_chars and loss_sha256 (all text under the loss spans, unescaped),
    formatted_chars."""
    pieces = materialize(formatted.select("conv_id", "formatted", "loss").mapInArrow(_read_back(template), _PIECE_DDL), "chat")
    rest = pieces.where("turns is not null").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece") \
        .mapInArrow(_finish, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                             "loss_sha256 string, formatted_chars bigint")
    return pieces.where("turns is null").select(*_DIGEST).unionByName(rest)
