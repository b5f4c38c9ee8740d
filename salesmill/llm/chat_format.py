"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation (all control strings in `CONTROL`):

    conversation := turn*
    turn         := "<s>[INST] " text " [/INST]"                 a user's turn
                  | "<s>[REPLY] " text "</s>"                    an assistant's turn
                  | "<s>[ROLE " name "] " text " [/ROLE]"        any other role

Inside texts and names a backslash before a character stands for that character. A text is first rendered as it is; the
result is parsed again, and while the turns found differ from the source, the conflicting texts are escaped more: first
the starts of control strings (and backslashes that would be read as escapes), then every backslash and control
character. The last level always parses back: no control string is left and every backslash is doubled.

The loss mask is a list of [start, end) code-point spans of the formatted text, one per assistant turn.

Turns are ordered by turn, then role, then text; null text is empty, a null role is the empty name; a null conversation
id is a conversation of its own. A conversation is one string in the end, so it is gathered into one row.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

CONTROL = ("<s>", "</s>", "[INST] ", " [/INST]", "[REPLY] ", "[ROLE ", "] ", " [/ROLE]")
#: Role: the strings before and after its text.
FRAMES = {"user": ("<s>[INST] ", " [/INST]"), "assistant": ("<s>[REPLY] ", "</s>")}

_STARTS = re.compile("|".join(map(re.escape, CONTROL)) + r"|\\")
_SPECIAL = re.compile(r"[\\<\[\] ]")

Turn = tuple[str, str]


def escape(text: str, level: int) -> str:
    if level == 0:
        return text
    if level == 1:
        return _STARTS.sub(lambda m: "\\" + m[0], text)
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def render(turns: list[Turn], levels: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the spans of the assistant's texts in it."""
    parts: list[str] = []
    spans, at = [], 0
    for (role, text), level in zip(turns, levels):
        before, after = FRAMES.get(role) or (f"<s>[ROLE {escape(role, 2)}] ", " [/ROLE]")
        body = escape(text, level)
        if role == "assistant":
            spans.append((at + len(before), at + len(before) + len(body)))
        parts += before, body, after
        at += len(before) + len(body) + len(after)
    return "".join(parts), spans


def _until(text: str, at: int, end: str) -> tuple[str, int]:
    """The unescaped text from `at` up to the first unescaped `end`, and the place after it; ValueError if there is none."""
    out = []
    find = re.compile(re.escape(end) + r"|\\").search
    while m := find(text, at):
        out.append(text[at : m.start()])
        if m[0] == end:
            return "".join(out), m.end()
        out.append(text[m.end() : m.end() + 1])
        at = m.end() + 1
    raise ValueError(f"no {end!r} after {at}")


def parse(text: str) -> list[Turn]:
    """The turns of a formatted text; ValueError where it breaks the grammar."""
    turns, at = [], 0
    while at < len(text):
        for role, (before, after) in FRAMES.items():
            if text.startswith(before, at):
                body, at = _until(text, at + len(before), after)
                break
        else:
            if not text.startswith("<s>[ROLE ", at):
                raise ValueError(f"no turn starts at {at}")
            role, at = _until(text, at + len("<s>[ROLE "), "] ")
            body, at = _until(text, at, " [/ROLE]")
        turns.append((role, body))
    return turns


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns: list[Turn]) -> tuple[str, list[tuple[int, int]], int]:
    """The formatted text, the loss spans, and the number of texts that were escaped."""
    levels = [0] * len(turns)
    # Whether a text survives does not depend on its neighbours, so conflicts are settled text by text.
    for i, turn in enumerate(turns):
        while levels[i] < 2:
            try:
                if parse(render([turn], [levels[i]])[0]) == [turn]:
                    break
            except ValueError:
                pass
            levels[i] += 1
    text, spans = render(turns, levels)
    if parse(text) != turns:
        raise AssertionError("the formatted conversation does not read back")
    return text, spans, sum(level > 0 for level in levels)


def formatted(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted, loss_spans, n_escaped: one row per conversation."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = [format_turns([(t["role"], t["text"]) for t in conv]) for conv in batch.column("turns").to_pylist()]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                pa.array([text for text, _, _ in done], pa.string()),
                pa.array([[{"start": a, "end": b} for a, b in spans] for _, spans, _ in done], span),
                pa.array([n for _, _, n in done], pa.int64()),
            ],
            names=["conv_id", "formatted", "loss_spans", "n_escaped"],
        )

    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    grouped = grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    return map_batches(grouped, lambda: one, "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>, n_escaped long")
