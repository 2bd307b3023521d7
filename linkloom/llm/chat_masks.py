"""Chat formatting: offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the
sorted spans of its trained turns are intersected with the sorted token spans by
binary search.

The template is ``<s>`` role newline text ``</s>`` per turn, user texts inside
``[INST]`` ... ``[/INST]``. The four control strings are tokens of their own, so a
token never crosses the border of a text. Control strings that occur inside a text
get a backslash after their first character (``<\\s>``), and a text that already
has such backslashes gets one more, which ``unescape`` takes away again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, tidy

#: The control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = re.compile(r"(<)(\\*)(/?s>)|(\[)(\\*)(/?INST\])")
_ESCAPED = re.compile(r"(<)\\(\\*)(/?s>)|(\[)\\(\\*)(/?INST\])")

#: Texts of one row of the result together have about this many characters at most, or one turn.
SEGMENT_CHARS = 1 << 21

SCHEMA = (
    "conv_id long, segment int, text string, input_ids array<int>, token_starts array<int>, "
    "token_ends array<int>, loss_mask array<boolean>, turns array<struct<role_start int, text_start int, text_end int, trained boolean>>"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[1] or m[4]}\\{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"{m[1] or m[4]}{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def escape_role(role: str) -> str:
    """A role ends at the line end, so line ends and backslashes in it are escaped too."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Template:
    trained: tuple[str, ...] = ("assistant",)

    def turn(self, role: str, text: str) -> tuple[str, int, int, int]:
        """Rendered turn and where its role starts and its text starts and ends."""
        head = f"<s>{escape_role(role)}\n"
        opening, closing = ("[INST]", "[/INST]") if role == "user" else ("", "")
        body = escape(text)
        start = len(head) + len(opening)
        return f"{head}{opening}{body}{closing}</s>", 3, start, start + len(body)


def masked(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that overlap one of the sorted spans. Starts and ends of tokens never
    fall, so the tokens of a span are one run, found by two binary searches."""
    mask = np.zeros(len(starts), bool)
    if spans:
        low, high = np.asarray(spans, np.int64).T
        first = np.searchsorted(ends, low, side="right")
        last = np.searchsorted(starts, high, side="left")
        for a, b, empty in zip(first, last, low == high):
            if not empty:
                mask[a:b] = True
    return mask


def _tokenizer(definition: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True  # the vocabulary's own special strings are plain text inside a text
    tokenizer.add_tokens([AddedToken(c, normalized=False, special=False) for c in CONTROLS])
    return tokenizer


def _segments(batches: Iterator[pa.RecordBatch], limit: int):
    """(conversation, number of the segment, [(role, text)]) in order; rows arrive sorted."""
    now, number, turns, chars = None, 0, [], 0
    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if turns and (conv != now or chars + len(text) > limit):
                yield now, number, turns
                number, turns, chars = (number + 1, [], 0) if conv == now else (0, [], 0)
            elif not turns:
                number = 0
            now = conv
            turns.append((role, text))
            chars += len(text)
    if turns:
        yield now, number, turns


def format_chats(
    conversations: DataFrame,
    tokenizer_json: str,
    template: Template = Template(),
    segment_chars: int = SEGMENT_CHARS,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id, segment, text`` (formatted),
    ``input_ids, token_starts, token_ends`` (offsets in code points), ``loss_mask``
    (per token) and ``turns`` (spans of roles' starts and texts).

    ``tokenizer_json`` is the tokenizer's definition. Turns are ordered by ``turn``
    (nulls first), ties by role and text. Null roles and texts are empty ones; rows
    with a null ``conv_id`` are one conversation. Other columns are not read.

    A conversation of more than ``segment_chars`` characters comes as several rows,
    cut between turns (which no token crosses), consecutive and in order within one
    partition: a task never holds more than one segment and one batch of rows."""
    empty = F.lit("")
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")

    @tidy
    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_json)
        schema = None
        out: list[tuple] = []
        size = 0
        for conv, number, turns in _segments(batches, segment_chars):
            pieces, spans, at = [], [], 0
            for who, what in turns:
                piece, a, b, c = template.turn(who, what)
                pieces.append(piece)
                spans.append({"role_start": at + a, "text_start": at + b, "text_end": at + c, "trained": who in template.trained})
                at += len(piece)
            whole = "".join(pieces)
            encoded = tokenizer.encode(whole, add_special_tokens=False)
            offsets = np.asarray(encoded.offsets, np.int64).reshape(-1, 2)
            mask = masked(offsets[:, 0], offsets[:, 1], [(s["text_start"], s["text_end"]) for s in spans if s["trained"]])
            out.append((conv, number, whole, np.asarray(encoded.ids, np.int32), offsets[:, 0].astype(np.int32), offsets[:, 1].astype(np.int32), mask, spans))
            size += len(whole)
            if size > segment_chars or len(out) >= 500:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    return shipped(rows.select("conv_id", "role", "text")).mapInArrow(render, SCHEMA)


_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int32()), ("text", pa.string()), ("input_ids", pa.list_(pa.int32())),
    ("token_starts", pa.list_(pa.int32())), ("token_ends", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_())),
    ("turns", pa.list_(pa.struct([("role_start", pa.int32()), ("text_start", pa.int32()), ("text_end", pa.int32()), ("trained", pa.bool_())]))),
])


def _batch(chats: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*chats))
    arrays = []
    for field, values in zip(_ARROW, columns):
        if isinstance(values[0], np.ndarray):
            ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values), field.type.value_type)))
        else:
            arrays.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text; the inverse of the template."""
    turns = []
    for piece in text.split("</s>")[:-1]:
        role, body = piece[len("<s>"):].split("\n", 1)
        role = unescape_role(role)
        if role == "user":
            body = body[len("[INST]"): len(body) - len("[/INST]")]
        turns.append((role, unescape(body)))
    return turns


def masked_texts(text: str, starts, ends, mask) -> list[str]:
    """The unescaped texts under the mask: one per run of masked tokens."""
    on = np.asarray(mask, bool)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], on, [False])).astype(np.int8)))
    return [unescape(text[starts[a]: ends[b - 1]]) for a, b in zip(edges[::2], edges[1::2])]
