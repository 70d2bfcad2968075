r"""Conversations rendered by a template, and read back from what was rendered.

Grammar of a rendered conversation, deterministic from left to right:

    conversation = { turn }
    turn = open(role) body close(role)

``MARKS`` has the marks of each role; any other role is named in its mark. Between two marks
everything is body, and a control string inside a body is escaped: a backslash after its first
character, one more if there are some already. Reading takes one away.

Every turn makes the round trip when it is rendered: the rendered text is parsed, and if what
comes back is not the given role and text, the content in conflict is escaped and parsed again. A
turn that still differs is an error. Turns are marked off by themselves, so a conversation is
the concatenation of its turns in order and no task holds a whole one; the loss mask is a range of
characters in each turn.

Reading back streams over the turns of a conversation in order, with one open turn in memory. Its
digests run over a conversation from the first turn to the last, so the turns of one conversation
pass through one task, in order and without being held.

Defined cases: a null text is empty, as is a null role. Turns come in the order of ``turn`` (null
first), and ties in that of their rendered text, so repeated rows are repeated turns. Rows without
a conversation id make one conversation. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Before and after the body, by role.
MARKS = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s> ", " </s>"),
}
NAMED = ("[ROLE] ", " [TEXT] ", " [/ROLE]")  # before the name of any other role, between, and after the body
LOSS_ROLE = "assistant"

CONTROLS = sorted({m.strip() for pair in [*MARKS.values(), NAMED] for m in pair})
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))


def _guarded(slashes: str) -> re.Pattern:
    return re.compile("|".join(rf"(?<={re.escape(c[0])}){slashes}(?={re.escape(c[1:])})" for c in CONTROLS))


_PLACE, _ESCAPED = _guarded(r"\\*"), _guarded(r"\\+")


class Conflict(ValueError):
    """Text that the grammar does not cover."""


def escape(text: str) -> str:
    return _PLACE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][1:], text)


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin of the body, its end) of each turn."""
    openings = {m: role for role, (m, _) in MARKS.items()} | {NAMED[0]: None}
    at = 0
    while at < len(rendered):
        mark = next((m for m in openings if rendered.startswith(m, at)), None)
        if mark is None:
            raise Conflict(f"no turn begins at {at}")
        role, at = openings[mark], at + len(mark)
        if role is None:
            name, at = _body(rendered, at, NAMED[1])
            role, close, begin = unescape(name), NAMED[2], at
            if role in MARKS:
                raise Conflict(f"{role} has marks of its own")
        else:
            close, begin = MARKS[role][1], at
        body, at = _body(rendered, at, close)
        yield role, unescape(body), begin, begin + len(body)


def _body(rendered: str, at: int, close: str) -> tuple[str, int]:
    """What stands before the next control string, which must be that of ``close``, and where it goes on."""
    control = _CONTROL.search(rendered, at)
    if control is None:
        raise Conflict(f"{close!r} is missing after {at}")
    end = control.start() - (len(close) - len(close.lstrip()))
    if end < at or not rendered.startswith(close, end):
        raise Conflict(f"{control[0]} at {control.start()} where {close!r} is due")
    return rendered[at:end], end + len(close)


def render(role: str, text: str) -> tuple[str, int, int]:
    """(rendered turn, begin and end of its body), after a round trip through ``parse``."""
    name, body = role, text
    while True:
        if role in MARKS:
            begin, close = MARKS[role]
        else:
            begin, close = f"{NAMED[0]}{name}{NAMED[1]}", NAMED[2]
        turn = begin + body + close
        if _recovered(turn) == [(role, text)]:
            return turn, len(begin), len(begin) + len(body)
        if (name, body) != (role, text):
            raise Conflict(f"no round trip for a turn of {role!r}")
        name, body = escape(role), escape(text)


def _recovered(turn: str) -> list[tuple[str, str]] | None:
    try:
        return [(role, text) for role, text, _, _ in parse(turn)]
    except Conflict:
        return None


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, rendered, loss_from, loss_to): the rendered turns; the loss range is null where nothing is learned."""

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                turn, begin, end = render(role or "", text or "")
                made.append((turn, begin, end) if role == LOSS_ROLE else (turn, None, None))
            columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["conv_id", "turn", "rendered", "loss_from", "loss_to"])

    given = turns.select("conv_id", "turn", "role", "text")
    kinds = {f.name: f.dataType.simpleString() for f in given.schema.fields}
    return given.mapInArrow(rendered, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, rendered string, loss_from long, loss_to long")


_DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Reading:
    """What has been read of one conversation."""

    def __init__(self, key: object):
        self.key, self.turns, self.loss_chars, self.chars = key, 0, 0, 0
        self.said, self.learned = sha256(), sha256()

    def add(self, rendered: str, loss_from: int | None, loss_to: int | None) -> None:
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.said.update(f"{role}\n{text}\n".encode())
        if loss_from is not None:
            learned = unescape(rendered[loss_from:loss_to])
            self.loss_chars += len(learned)
            self.learned.update(learned.encode())
        self.chars += len(rendered)

    def row(self) -> tuple:
        return self.key, self.turns, self.said.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from rendered turns alone."""
    key = formatted.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading: _Reading | None = None
        for batch in batches:
            done = []
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for conv, rendered, loss_from, loss_to in zip(*columns, strict=True):
                if reading is None or reading.key != conv:
                    if reading is not None:
                        done.append(reading.row())
                    reading = _Reading(conv)
                reading.add(rendered, loss_from, loss_to)
            if done:
                yield _rows(done, batch.column(0).type)
            last = batch.column(0).type
        if reading is not None:
            yield _rows([reading.row()], last)

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "rendered")
    return dealt.select("conv_id", "rendered", "loss_from", "loss_to").mapInArrow(read, f"conv_id {key}, {_DIGESTS}")


def _rows(done: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    kinds = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
