"""Chat formatting with a checked round trip.

The template has one pair of control strings per kind of turn::

    user        [INST] text [/INST]          (without the blanks)
    assistant   <s> text </s>
    other role  <<SYS>> role newline text <</SYS>>

A deterministic parser reads rendered text back. Each turn is rendered as it
is, reparsed and compared with its source; while they differ, one more kind of
conflicting control string is escaped and the turn is tried again. Escaping
puts a backslash after the first character of a control string, and one more
where backslashes already stand there, so that it is reversible: ``[INST]``
-> ``[\\INST]`` -> ``[\\\\INST]``. The parser removes one of them.

Turns begin and end with control strings that no text can hold unescaped, so
a conversation is the plain concatenation of its turns, and reading back turn
by turn equals reading back the whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")
_OPEN = {"[INST]": "[/INST]", "<s>": "</s>", "<<SYS>>": "<</SYS>>"}
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROLS))
_KIND = {c: re.compile(rf"({re.escape(c[0])})(\\*{re.escape(c[1:])})") for c in CONTROLS}
#: In role names every character that could start a control string or end the name.
_ROLE = {"%": "%25", "\n": "%0A", "<": "%3C", "[": "%5B"}


def escape(text: str, kinds) -> str:
    """``text`` with one more backslash in each control string of ``kinds``."""
    for c in kinds:
        text = _KIND[c].sub(r"\1\\\2", text)
    return text


def unescape(text: str) -> str:
    """Remove one backslash from every escaped control string."""
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def render(role: str, text: str, kinds=()) -> tuple[str, int, int]:
    """The rendered turn, and where the (escaped) text stands in it."""
    if role == "user":
        head, tail = "[INST]", "[/INST]"
    elif role == "assistant":
        head, tail = "<s>", "</s>"
    else:
        head = "<<SYS>>" + "".join(_ROLE.get(x, x) for x in role) + "\n"
        tail = "<</SYS>>"
    body = escape(text, kinds)
    return head + body + tail, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; ``ValueError`` where the grammar does not hold."""
    turns, at, n = [], 0, len(formatted)
    while at < n:
        head = _CONTROL.match(formatted, at)
        if not head or head[0] not in _OPEN:
            raise ValueError(f"no turn begins at {at}")
        tail = _CONTROL.search(formatted, head.end())
        if not tail or tail[0] != _OPEN[head[0]]:
            raise ValueError(f"the turn at {at} is not closed")
        body = formatted[head.end():tail.start()]
        if head[0] == "<<SYS>>":
            name, found, body = body.partition("\n")
            if not found:
                raise ValueError(f"the turn at {at} has no role")
            role = re.sub("%25|%0A|%3C|%5B", lambda m: chr(int(m[0][1:], 16)), name)
        else:
            role = "user" if head[0] == "[INST]" else "assistant"
        turns.append((role, unescape(body)))
        at = tail.end()
    return turns


def render_checked(role: str, text: str) -> tuple[str, int, int]:
    """Render, reparse and escape further conflicting kinds until the turn comes back identical."""
    kinds: list[str] = []
    while True:
        out = render(role, text, kinds)
        try:
            if parse(out[0]) == [(role, text)]:
                return out
        except ValueError:
            pass
        left = [c for c in CONTROLS if c not in kinds and _KIND[c].search(text)]
        if not left:
            raise ValueError("the template cannot hold this turn")
        kinds.append(left[0])


_TURNS = "conv_id long, turn long, role string, text string, formatted string, text_start long, text_end long"


def _render_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        done = [render_checked(r, t) for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
        more = [pa.array([x[0] for x in done], pa.string()), *(pa.array([x[i] for x in done], pa.int64()) for i in (1, 2))]
        yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, "formatted", "text_start", "text_end"])


def format_chat(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, role, text, formatted, text_start, text_end.

    ``formatted`` is the turn's piece of the conversation's text (pieces in
    order of turn join without a separator); text_start/text_end say where its
    text stands in the piece: for assistant rows that is the loss mask.
    Null text or role: empty. Rows that repeat are each a turn. Other columns
    of the input are ignored; an empty table gives no rows.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_render_batches, _TURNS)


_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and turn; only the digests of one conversation are held."""
    nothing = object()
    now, state, out = nothing, None, []

    def close():
        if now is not nothing:
            n, turns, chars, loss, length = state
            out.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), length))

    for b in batches:
        for conv, piece, start, end in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "text_start", "text_end"))):
            if conv != now:
                close()
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(piece):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if role == "assistant":
                    masked = unescape(piece[start:end])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
            state[4] += len(piece)
        if len(out) >= 1000:
            yield _digest_frame(out)
            out.clear()
    close()
    yield _digest_frame(out)


def _digest_frame(rows: list) -> pa.RecordBatch:
    fields = [f.split() for f in _DIGEST.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if t == "long" else pa.string()) for c, (_, t) in zip(columns, fields)],
                                      [n for n, _ in fields])


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation, what the formatted pieces hold when parsed again.

    A digest over a conversation needs its turns in order (turn, then role,
    then text where turns tie), so they are sorted and stream through one task; it holds one turn
    and two hash states, however long the conversation is.
    """
    ordered = (turns.select("conv_id", "turn", "role", "text", "formatted", "text_start", "text_end")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
               .select("conv_id", "formatted", "text_start", "text_end"))
    return ordered.mapInArrow(_digest_batches, _DIGEST)
