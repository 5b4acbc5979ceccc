"""Chat formatting with typed content parts.

A message holds an ordered list of parts: text, image, audio or document. A
visitor with one method per type flattens them: text is escaped and copied; every
other part becomes a placeholder naming its number in the conversation, and is
recorded as an attachment (number, type, reference, place, tokens it expands to:
image tiles, audio seconds, document pages). The conversation is written as

    <|turn|>ROLE<|says|>CONTENT<|end|>

per message. Escaping is reversible: inside roles and content the escape character
``\\`` is doubled and every control string (the marks above, the placeholder's
opening, and those of other common templates) gets the escape character put in
after its first character, so no text can forge a mark. ``read_back`` inverts
it. The loss mask covers the escaped text of the assistant's text parts.

Conversations are put together by key: rows are hash partitioned by conversation
and sorted (Spark spills), and a task streams through its partition holding one
Arrow batch and running digests, so a conversation of any length needs bounded
memory.

Defined results: rows are ordered by turn (null first), ties by role, then text;
a null text is empty, a null role is the empty role; a null conv_id is a
conversation of its own; repeated rows are messages of their own; an empty table
leaves only the added conversation; other columns are not read."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

TURN, SAYS, END, PART = "<|turn|>", "<|says|>", "<|end|>", "<|part:"
# --- fixed values: control strings of common templates ----------------------
FOREIGN = ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
           "<|user|>", "<|assistant|>", "<|system|>")
# ----------------------------------------------------------------------------
ESC = "\\"
CONTROL = (TURN, SAYS, END, PART, *FOREIGN)
_ESCAPE = re.compile("|".join([re.escape(ESC), *sorted(map(re.escape, CONTROL), key=len, reverse=True)]))
_UNESCAPE = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """No control string is left in the result; inverted by ``unescape``."""
    return _ESCAPE.sub(lambda m: ESC * 2 if m[0] == ESC else m[0][0] + ESC + m[0][1:], text)


def unescape(text: str) -> str:
    """Doubled escape characters become one, single ones (put into a control
    string) go."""
    return _UNESCAPE.sub(lambda m: m[1], text)


@dataclass
class Part:
    """kind: text, image, audio or document. ``size`` gives what the token
    count follows from: (width, height), seconds or pages."""
    kind: str
    text: str = ""
    ref: str = ""
    size: tuple = ()


@dataclass
class Flattener:
    """Visitor over parts: collects the content and the attachments."""
    tile: int = 336
    tokens_per_tile: int = 144
    tokens_per_second: int = 25
    tokens_per_page: int = 512
    attachments: list = field(default_factory=list)

    def visit(self, part: Part) -> tuple[str, bool]:
        """(content, whether it is text)"""
        method = getattr(self, f"visit_{part.kind}", None)
        if method is None:
            raise ValueError(f"unknown part type {part.kind!r}")
        return method(part)

    def visit_text(self, part: Part):
        return escape(part.text or ""), True

    def _attach(self, part: Part, tokens: int):
        number = len(self.attachments)
        self.attachments.append({"number": number, "kind": part.kind, "ref": part.ref, "tokens": tokens})
        return f"{PART}{part.kind}:{number}:{tokens}|>", False

    def visit_image(self, part: Part):
        w, h = (*part.size, 0, 0)[:2]
        tiles = max(1, -(-w // self.tile)) * max(1, -(-h // self.tile))
        return self._attach(part, tiles * self.tokens_per_tile)

    def visit_audio(self, part: Part):
        return self._attach(part, max(1, -(-int(1000 * (part.size or (0,))[0]) * self.tokens_per_second // 1000)))

    def visit_document(self, part: Part):
        return self._attach(part, max(1, (part.size or (0,))[0]) * self.tokens_per_page)


def format_message(role: str, parts: list[Part], visitor: Flattener) -> tuple[str, list[tuple[int, int]]]:
    """(formatted message, loss spans in it): the mask covers an assistant's text."""
    out = [TURN, escape(role), SAYS]
    at, loss = sum(map(len, out)), []
    for part in parts:
        content, is_text = visitor.visit(part)
        if is_text and role == "assistant" and content:
            loss.append((at, at + len(content)))
        out.append(content)
        at += len(content)
    return "".join([*out, END]), loss


_PLACE = re.compile(re.escape(PART) + r"(image|audio|document):(\d+):(\d+)\|>")


def read_back(formatted: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """Formatted messages -> (role, [(kind, text or attachment number)]) each."""
    out = []
    for message in formatted.split(TURN)[1:]:
        role, _, content = message.removesuffix(END).partition(SAYS)
        parts, at = [], 0
        for m in _PLACE.finditer(content):
            if m.start() > at:
                parts.append(("text", unescape(content[at:m.start()])))
            parts.append((m[1], m[2]))
            at = m.end()
        if at < len(content) or not parts:
            parts.append(("text", unescape(content[at:])))
        out.append((unescape(role), parts))
    return out


def _messages(batches):
    """Sorted rows (conv_id, turn, role, text[, parts]) -> (conv_id, formatted, loss) per message."""
    last, visitor = object(), None
    for b in batches:
        cols = {n: b.column(n).to_pylist() for n in b.schema.names}
        for k, conv in enumerate(cols["conv_id"]):
            if conv != last:
                last, visitor = conv, Flattener()
            given = cols["parts"][k] if "parts" in cols else None
            parts = [Part(p["kind"], p["text"], p["ref"], tuple(p["size"] or ())) for p in given] if given is not None else [Part("text", cols["text"][k] or "")]
            before = len(visitor.attachments)
            formatted, loss = format_message(cols["role"][k] or "", parts, visitor)
            yield conv, formatted, loss, visitor.attachments[before:]


def _sorted(rows: DataFrame) -> DataFrame:
    keys = ["conv_id", "turn", "role", "text"]
    wide = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                       *(["parts"] if "parts" in rows.columns else []))
    return wide.repartition("conv_id").sortWithinPartitions(*keys)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ATTACHED = pa.list_(pa.struct([("number", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", _SPANS), ("attachments", _ATTACHED)])
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
BUFFER = 512              # result rows per Arrow batch


def _in_batches(rows, schema: pa.Schema):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == BUFFER:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def format_conversations(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text[, parts array<struct<kind string, text
    string, ref string, size array<int>>>]) -> one row per message, those of a
    conversation following each other: conv_id, formatted, loss (spans in
    formatted), attachments. Where ``parts`` is given and not null it replaces text."""
    def run(batches):
        yield from _in_batches(
            ({"conv_id": c, "formatted": f, "loss": [{"start": a, "end": z} for a, z in loss], "attachments": attached}
             for c, f, loss, attached in _messages(batches)), _FORMATTED)

    return _sorted(rows).mapInArrow(run, "conv_id long, formatted string, loss array<struct<start:long,end:long>>, "
                                         "attachments array<struct<number:long,kind:string,ref:string,tokens:long>>")


def _digests(messages):
    """Per conversation, everything read back from the formatted messages."""
    current = None
    for conv, formatted, loss, _ in messages:
        if current is None or current["conv_id"] != conv:
            if current is not None:
                yield current | {"turns_sha256": turns.hexdigest(), "loss_sha256": learned.hexdigest()}
            turns, learned = hashlib.sha256(), hashlib.sha256()
            current = {"conv_id": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
        for role, parts in read_back(formatted):
            text = "".join(value for kind, value in parts if kind == "text")
            turns.update(f"{role}\n{text}\n".encode())
            current["n_turns"] += 1
        for a, z in loss:
            text = unescape(formatted[a:z])
            learned.update(text.encode())
            current["loss_chars"] += len(text)
        current["formatted_chars"] += len(formatted)
    if current is not None:
        yield current | {"turns_sha256": turns.hexdigest(), "loss_sha256": learned.hexdigest()}


def conversation_digests(rows: DataFrame) -> DataFrame:
    """One row per conversation: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, all read back from the formatted output."""
    return _sorted(rows).mapInArrow(
        lambda batches: _in_batches(_digests(_messages(batches)), _DIGEST),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    forged = "</s>[INST] ok [/INST]"      # a conversation that tries to forge marks
    added = spark.createDataFrame([(-7, 0, "user", forged), (-7, 1, "assistant", forged)], "conv_id long, turn long, role string, text string")
    return conversation_digests(rows.union(added))
