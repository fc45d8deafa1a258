r"""Conversations from event logs, rendered for training.

Template, a turn: ``### role: text</turn>`` and a line end. In roles and texts ``\`` is written
``\\``, ``#`` ``\h``, ``<`` ``\l`` and, in roles, ``:`` ``\c``; so no text can hold a mark.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.llm.common import free_name

OPEN, CLOSE = "### ", "</turn>\n"
LEARNED_ROLE = "assistant"
_TURN = re.compile(r"### ([^:]*): ([^<]*)</turn>\n")
_ESCAPED = re.compile(r"\\(.)", re.S)
_PLAIN = {"\\": "\\", "h": "#", "l": "<", "c": ":"}

EVENTS = "conv_id long, turn long, message long, seq int, kind string, role string, text string"
#: What an event does to its message: ``open`` names its role, ``delta`` appends text, ``edit`` replaces
#: all text by its own, ``regenerate`` throws the text away, ``delete`` the message.
KINDS = ("open", "delta", "edit", "regenerate", "delete")


def escape(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("#", "\\h").replace("<", "\\l")
    return text.replace(":", "\\c") if role else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text) if "\\" in text else text


def log_of(conversations: DataFrame) -> DataFrame:
    """An event log of finished turns, as a chat service streams it: EVENTS columns.

    Each turn is opened; an assistant's first draft is dropped and generated again, in two
    deltas; any other turn is sent in part and then edited to its whole text.
    Rows of equal conv_id and turn are messages of their own.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    head, tail = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.char_length(text))

    def event(seq: int, kind: str, value=None, who=None):
        return F.struct(
            F.lit(seq).alias("seq"),
            F.lit(kind).alias("kind"),
            (F.lit(None).cast("string") if who is None else who).alias("role"),
            (F.lit(None).cast("string") if value is None else value).alias("text"),
        )

    answered = [
        event(0, "open", who=role),
        event(1, "delta", tail),
        event(2, "regenerate"),
        event(3, "delta", head),
        event(4, "delta", tail),
    ]
    edited = [event(0, "open", who=role), event(1, "delta", head), event(2, "edit", text)]
    events = F.when(role == LEARNED_ROLE, F.array(*answered)).otherwise(F.array(*edited))
    message = free_name(conversations, "message")
    rows = conversations.withColumn(message, F.monotonically_increasing_id())  # before the rows are split up
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col(message).alias("message"),
        F.explode(events).alias("e"),
    ).select("conv_id", "turn", "message", "e.*")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted events of messages to final messages; one message is held at a time."""
    names = ["conv_id", "turn", "message", "role", "text"]
    types = [pa.int64()] * 3 + [pa.string()] * 2
    key, role, text, gone, out = None, None, [], False, []

    def made() -> pa.RecordBatch:
        columns = zip(*out) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for row in batch.to_pylist():
            new = (row["conv_id"], row["turn"], row["message"])
            if new != key:
                if key is not None and not gone:
                    out.append((*key, role or "", "".join(text)))
                key, role, text, gone = new, None, [], False
            kind = row["kind"]
            if kind == "open":
                role = row["role"]
            elif kind == "delta":
                text.append(row["text"] or "")
            elif kind == "edit":
                text = [row["text"] or ""]
            elif kind == "regenerate":
                text = []
            elif kind == "delete":
                gone = True
            else:
                raise ValueError(f"unknown kind of event: {kind}")
        yield made()
        out.clear()
    if key is not None and not gone:
        out.append((*key, role or "", "".join(text)))
        yield made()


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, message, role, text): the last state of every message of the log.

    The log is dealt by message, so that the events of a hot conversation meet in many tasks, and
    sorted by sequence number. A message without ``open`` has an empty role; null text is empty.
    """
    dealt = events.repartition("conv_id", "turn", "message")
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "message", "seq")
    return ordered.mapInArrow(_fold, "conv_id long, turn long, message long, role string, text string")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted messages to one text a conversation, with the spans to learn."""
    key, parts, spans, at, started = None, [], [], 0, False
    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        ids, texts, masks = zip(*out) if out else ([], [], [])
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        columns = [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(masks, spans_type)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "loss"])

    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
            if not started or conv != key:
                if started:
                    out.append((key, "".join(parts), spans))
                key, parts, spans, at, started = conv, [], [], 0, True
            head, body = f"{OPEN}{escape(role, True)}: ", escape(text)
            if role == LEARNED_ROLE:
                spans.append({"start": at + len(head), "length": len(body)})
            parts += [head, body, CLOSE]
            at += len(head) + len(body) + len(CLOSE)
        if out:
            yield made()
            out.clear()
    if started:
        out.append((key, "".join(parts), spans))
        yield made()


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): each conversation as one text, its turns in order.

    ``loss`` has the spans, in code points of ``formatted``, of the assistant's texts. Turns with equal
    number are in the order of role and text; null turns are first. Rows without conv_id are one conversation.
    """
    ordered = messages.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "message")
    return ordered.mapInArrow(
        _render, "conv_id long, formatted string, loss array<struct<start:long,length:long>>"
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn; the text must be the template's, from end to end."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            break
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError(f"not the template at {at}")
    return turns


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of the turns and of the learned text, from the rendered text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                turns = parse(row["formatted"])
                whole, learned, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, text in turns:
                    whole.update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    text = unescape(row["formatted"][span["start"] : span["start"] + span["length"]])
                    learned.update(text.encode())
                    chars += len(text)
                out.append((row["conv_id"], len(turns), whole.hexdigest(), chars, learned.hexdigest(), len(row["formatted"])))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return rendered.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Event log to rendered conversations."""
    return render(fold(events))
