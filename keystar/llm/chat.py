"""Chat formatting: an event log folded into messages, rendered with a loss mask.

The log is partitioned by conversation and sorted by sequence number. One pass folds
streamed deltas, edits and regenerations; a message is rendered as soon as it can no longer
change, so a task holds the open messages of one conversation and not its history of events.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar.llm.common import record, rows_of

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"

EVENTS = "conv_id long, seq long, part long, turn long, kind string, role string, text string"
SEGMENTS = "conv_id long, position long, role string, segment string, mask_at int, mask_end int"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)
#: Code points of one streamed delta where whole texts are turned into a log.
DELTA_CHARS = 4096

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: each gains a backslash after ``<``, as do those that had some."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role in one line without control strings."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


@dataclass
class Message:
    role: str
    parts: list[str] = field(default_factory=list)


def render(role: str, text: str, trained: str) -> tuple[str, int | None, int | None]:
    """The segment of a message, and where its trained text starts and ends in it."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    masked = (len(head), len(head) + len(body)) if role == trained else (None, None)
    return f"{head}{body}{END}\n", *masked


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a rendered message."""
    head, _, rest = segment.removeprefix(START).partition("\n")
    return unescape_role(head), unescape(rest.removesuffix(f"{END}\n"))


class Fold:
    """The messages of one conversation while its events arrive in order."""

    def __init__(self) -> None:
        self.messages: dict[int, Message] = {}

    def take(self, turn: int, kind: str, role: str, text: str) -> None:
        """``open`` starts a message, ``delta`` appends to it, ``edit`` replaces its text,
        ``regenerate`` empties it for new deltas and drops the turns after it, ``drop``
        removes it. A delta or edit of a turn that was never opened opens it."""
        if kind == "regenerate":
            self.messages = {t: m for t, m in self.messages.items() if t < turn}
        if kind == "drop":
            self.messages.pop(turn, None)
            return
        message = self.messages.get(turn)
        if message is None or kind in ("open", "regenerate"):
            message = self.messages[turn] = Message(role)
        if kind == "edit":
            message.parts = [text]
        elif kind == "delta":
            message.parts.append(text)

    def final(self) -> Iterator[tuple[str, str]]:
        for turn in sorted(self.messages):
            yield self.messages[turn].role, "".join(self.messages[turn].parts)


def format_log(events: DataFrame, trained: str = "assistant") -> DataFrame:
    """Segments (conv_id, position, role, segment, mask_at, mask_end) in conversation order.

    Events (see ``EVENTS``) are sorted by seq and part. A ``settle`` event says that earlier
    turns will not change any more; they are rendered and forgotten, so a conversation of any
    length streams through a task. Concatenated segments are the formatted conversation; the
    mask marks the trained role's texts. Null texts and roles count as empty, an unknown kind
    does nothing but open its turn, events without a conversation form one of their own, no
    events give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, position = Fold(), object(), 0
        out: list[tuple] = []

        def flush() -> None:
            nonlocal position
            for role, text in state.final():
                out.append((current, position, role, *render(role, text, trained)))
                position += 1
            state.messages.clear()

        for batch in batches:
            for conv, _, _, turn, kind, role, text in rows_of(batch):
                if conv != current:
                    flush()
                    current, position = conv, 0
                if kind == "settle":
                    flush()
                else:
                    state.take(-1 if turn is None else turn, kind, role or "", text or "")
            if out:
                yield record(SEGMENTS, out)
                out.clear()
        flush()
        if out:
            yield record(SEGMENTS, out)

    ordered = (
        events.select(*_names(EVENTS))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", "part")
    )
    return ordered.mapInArrow(run, SEGMENTS)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation what its formatted text says: see ``DIGESTS``.

    Reads the output of ``format_log`` as it comes, in conversation order; hashes run along,
    so no conversation is held whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None
        for batch in batches:
            out = []
            for conv, _, _, segment, mask_at, mask_end in rows_of(batch):
                if state is None or conv != current:
                    if state is not None:
                        out.append(_digest(current, state))
                    current = conv
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if mask_at is not None:
                    loss = unescape(segment[mask_at:mask_end])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(segment)
            yield record(DIGESTS, out)
        if state is not None:
            yield record(DIGESTS, [_digest(current, state)])

    return segments.mapInArrow(run, DIGESTS)


def _digest(conv: int | None, state: list) -> tuple:
    turns, all_text, loss_chars, loss, chars = state
    return conv, turns, all_text.hexdigest(), loss_chars, loss.hexdigest(), chars


def message_log(messages: DataFrame) -> DataFrame:
    """Events that rebuild stored messages (conv_id, turn, role, text), as a client streams them.

    Each message is opened, streamed in deltas of bounded size and settled. Rows are ordered
    by turn, then role, then text (nulls first), so that repeated turns have a defined order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous, seq = object(), 0
        for batch in batches:
            out = []
            for conv, role, text in rows_of(batch):
                seq = seq + 1 if conv == previous else 0
                previous = conv
                body = text or ""
                pieces = [body[i : i + DELTA_CHARS] for i in range(0, len(body), DELTA_CHARS)]
                kinds = [("open", None), *(("delta", p) for p in pieces), ("settle", None)]
                for part, (kind, piece) in enumerate(kinds):
                    out.append((conv, seq, part, seq, kind, role, piece))
            yield record(EVENTS, out)

    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, EVENTS)


def with_rows(messages: DataFrame, extra: Iterable[tuple]) -> DataFrame:
    """``messages`` and a few literal rows (conv_id, turn, role, text)."""
    schema = "conv_id long, turn long, role string, text string"
    added = messages.sparkSession.createDataFrame(list(extra), schema)
    return messages.select("conv_id", "turn", "role", "text").unionByName(added)
