"""Chat formatting with a loss mask found by incremental rendering.

A template is a black box: a function from a list of (role, text) turns to a
string.  Rendering the first 1, 2, ... turns and comparing consecutive outputs
shows where each turn stands: what an output adds to the one before is the new
turn's span.  A template whose output is not a continuation of the one before
rewrites history, and is reported instead of being masked wrongly.

Rendering every prefix costs the square of the number of turns.  Past ``STRIDE``
turns, prefixes start at the last turn but one before a block of that many, and
the spans found are accepted only if, put together, they are the rendering of
the whole conversation; else all prefixes are rendered.

Inside a turn the spoken text is found the same way, without knowing the
template: the turn is rendered with its text and with an empty one, and what
differs between the common start and end is the text as written, escaped.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

STRIDE = 64
LEARNT_ROLES = ("assistant",)

# The marks of the default template, and what escapes stand for.
OPEN, CLOSE, END = "### ", ": ", " </turn>\n"
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c", "\n": "\\n"}
BACK = {v[1]: k for k, v in ESCAPES.items()}
_TEXT = {ord(k): v for k, v in ESCAPES.items() if k in "\\#<"}
_ROLE = str.maketrans(ESCAPES)


def escape(text: str) -> str:
    """Text in which no mark of the template can stand."""
    return text.translate(_TEXT)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: BACK[m[1]], text)


def render(turns: list[Turn]) -> str:
    """The default template: ``### role: text </turn>`` lines."""
    return "".join(f"{OPEN}{role.translate(_ROLE)}{CLOSE}{escape(text)}{END}" for role, text in turns)


def parse(formatted: str) -> list[Turn]:
    """The turns of a string that ``render`` made."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part[len(OPEN) :].partition(CLOSE)
        turns.append((unescape(role), unescape(text)))
    return turns


@dataclass(frozen=True)
class Formatted:
    """A rendered conversation: ``spans`` of turns, ``loss`` spans of learnt texts."""

    text: str
    spans: list[tuple[int, int]]
    loss: list[tuple[int, int]]
    rewrites: bool


def _prefix_spans(turns: list[Turn], template: Template) -> list[tuple[int, int]] | None:
    """Spans of the turns by rendering all prefixes; None if one is not continued."""
    spans, before = [], template([])
    for n in range(1, len(turns) + 1):
        now = template(turns[:n])
        if not now.startswith(before):
            return None
        spans.append((len(before), len(now)))
        before = now
    return spans


def turn_spans(turns: list[Turn], template: Template, whole: str) -> list[tuple[int, int]] | None:
    """Where each turn stands in ``whole``, the rendering of all of them."""
    if len(turns) <= STRIDE:
        return _prefix_spans(turns, template)
    spans, at = [], 0
    for low in range(0, len(turns), STRIDE):
        lead = min(low, 1)
        block = turns[low - lead : low + STRIDE]
        local = _prefix_spans(block, template)
        if local is None:
            return _prefix_spans(turns, template)
        text, first = template(block), local[lead][0] if lead else 0
        if whole[at : at + len(text) - first] != text[first:]:
            return _prefix_spans(turns, template)
        spans += [(at + a - first, at + b - first) for a, b in local[lead:]]
        at += len(text) - first
    return spans if at == len(whole) else _prefix_spans(turns, template)


def text_span(turn: Turn, shown: str, template: Template) -> tuple[int, int]:
    """Where the turn's text stands in what the template shows for the turn."""
    start = len(os.path.commonprefix([template([(turn[0], "")]), template([(turn[0], "x")])])) - len(template([]))
    end = len(template([(turn[0], "x")])) - len(template([])) - start - 1
    return start, len(shown) - end


def format_turns(turns: list[Turn], template: Template = render, learnt: tuple[str, ...] = LEARNT_ROLES) -> Formatted:
    """Render a conversation and mark the texts of the ``learnt`` roles."""
    whole = template(turns)
    spans = turn_spans(turns, template, whole)
    if spans is None:
        return Formatted(whole, [], [], True)
    loss = []
    for turn, (a, b) in zip(turns, spans):
        if turn[0] in learnt:
            low, high = text_span(turn, whole[a:b], template)
            loss.append((a + low, a + high))
    return Formatted(whole, spans, loss, False)


SCHEMA = (
    "conv_id BIGINT, formatted STRING, spans ARRAY<STRUCT<start: BIGINT, end: BIGINT>>, "
    "loss ARRAY<STRUCT<start: BIGINT, end: BIGINT>>, rewrites BOOLEAN"
)


def _format(template: Template, learnt: tuple[str, ...]):
    struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema(
        [("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", struct), ("loss", struct), ("rewrites", pa.bool_())]
    )

    def pairs(spans: list[tuple[int, int]]) -> list[dict]:
        return [{"start": a, "end": b} for a, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = []
                for row in batch.slice(low, 256).to_pylist():
                    made = format_turns([(t["role"], t["text"]) for t in row["turns"]], template, learnt)
                    rows.append((row["conv_id"], made.text, pairs(made.spans), pairs(made.loss), made.rewrites))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def format_conversations(
    conversations: DataFrame, template: Template = render, learnt: tuple[str, ...] = LEARNT_ROLES
) -> DataFrame:
    """(conv_id, formatted, spans, loss, rewrites): one row per conversation.

    Turns go by ``turn``, nulls first; equal turns by role and text.  Null texts
    and roles are empty, a null conv_id is a conversation of its own.  Positions
    count code points.  A conversation is one string, so its turns meet in one
    row; an empty table gives an empty one, further columns are unused.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return ordered.mapInArrow(_format(template, learnt), SCHEMA)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            turns = parse(row["formatted"])
            loss = "".join(unescape(row["formatted"][s["start"] : s["end"]]) for s in row["loss"])
            digests = [
                hashlib.sha256(t.encode()).hexdigest()
                for t in ("".join(f"{role}\n{text}\n" for role, text in turns), loss)
            ]
            out.append((row["conv_id"], len(turns), digests[0], len(loss), digests[1], len(row["formatted"])))
        columns = list(zip(*out)) or [()] * len(names)
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and learnt text as they stand in the formatted strings, as counts and digests."""
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        _read_back,
        "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, formatted_chars BIGINT",
    )
