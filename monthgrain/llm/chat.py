"""Chat formatting in budgeted windows.

Each conversation becomes windows of whole turns. A running sum of turn tokens decides where a
window ends; the next window repeats the system turn and a limited part of the turns just seen,
whose assistant text is left out of the loss. Every assistant turn is a target exactly once.

Spark deals and sorts the turns by conversation; tasks read them as a stream and hold one
window, so a conversation of any length needs no more memory than its largest window.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's control strings (fixed values).
OPEN, ROLE_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROL = re.compile(r"<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>")
TOKEN = re.compile(r"\w+|[^\w\s]")
#: Tokens that the marks of a turn count as.
MARKS = 4


def escape(text: str) -> str:
    """Text in which no control string occurs; ``unescape`` gives it back."""
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


@dataclass
class Turn:
    """One turn as it is written."""

    role: str
    body: str
    tokens: int

    @classmethod
    def of(cls, role: str, text: str) -> Turn:
        return cls(role, escape(text), len(TOKEN.findall(text)) + MARKS)

    @property
    def head(self) -> str:
        return f"{OPEN}{escape(self.role)}{ROLE_END}"


@dataclass
class Windows:
    """Cuts the turns of one conversation; ``add`` and ``end`` give windows as they fill.

    A window is (text, starts, ends, repeated, turns, tokens): the loss spans in code points,
    how many leading turns were seen before, how many turns there are, and their tokens.
    """

    budget: int
    history: int
    system: Turn | None = None
    old: list[Turn] = field(default_factory=list)
    new: list[Turn] = field(default_factory=list)
    used: int = 0

    def add(self, turn: Turn) -> Iterator[tuple]:
        if self.new and self.used + turn.tokens > self.budget:
            yield self._window()
            self._carry(turn.tokens)
        if self.system is None and not self.old and not self.new and turn.role == "system":
            self.system = turn
        self.new.append(turn)
        self.used += turn.tokens

    def end(self) -> Iterator[tuple]:
        if self.new:
            yield self._window()

    def _carry(self, coming: int) -> None:
        """What the next window repeats: the system turn, then the last turns that fit.

        A system turn of more than half the budget stands in the first window alone, so what is
        written stays within a small multiple of what was read.
        """
        if self.system and self.system.tokens > self.budget // 2:
            self.system = None
        seen = [t for t in [*self.old, *self.new] if t is not self.system]
        self.used = self.system.tokens if self.system else 0
        room = min(self.history, self.budget - self.used - coming)
        kept = 0
        for turn in reversed(seen):
            if turn.tokens > room:
                break
            room -= turn.tokens
            self.used += turn.tokens
            kept += 1
        self.old = ([self.system] if self.system else []) + seen[len(seen) - kept :]
        self.new = []

    def _window(self) -> tuple:
        parts, at, starts, ends = [], 0, [], []
        for k, turn in enumerate([*self.old, *self.new]):
            start = at + len(turn.head)
            parts += [turn.head, turn.body, CLOSE]
            at = start + len(turn.body) + len(CLOSE)
            if turn.role == "assistant" and k >= len(self.old):
                starts.append(start)
                ends.append(start + len(turn.body))
        turns = len(self.old) + len(self.new)
        return "".join(parts), starts, ends, len(self.old), turns, self.used


def parse(text: str) -> list[tuple[str, str, int]]:
    """(role, text, where its escaped text starts) of each turn in a window."""
    out, at = [], 0
    while at < len(text):
        role_end = text.index(ROLE_END, at)
        start = role_end + len(ROLE_END)
        end = text.index(CLOSE, start)
        out.append((unescape(text[at + len(OPEN) : role_end]), unescape(text[start:end]), start))
        at = end + len(CLOSE)
    return out


_WINDOWS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("formatted", pa.string()),
        ("loss_starts", pa.list_(pa.int64())),
        ("loss_ends", pa.list_(pa.int64())),
        ("repeated", pa.int64()),
        ("turns", pa.int64()),
        ("tokens", pa.int64()),
    ]
)
_WINDOW_KINDS = (
    "conv_id long, window long, formatted string, loss_starts array<long>, "
    "loss_ends array<long>, repeated long, turns long, tokens long"
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1 << 22) -> Iterator:
    """Rows in Arrow batches of about ``most`` characters; the third field is the text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[2])
        if size > most:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), schema.types, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=schema)


def windows(turns: DataFrame, budget: int = 512, history: int = 128) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as formatted windows, in order.

    Null texts and roles count as empty. Turns of equal number are ordered by role and text,
    turns without a number come first; rows without conv_id are one conversation. A turn longer
    than the budget has a window of its own with nothing repeated but the system turn. No rows
    give no windows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conv, state, number = None, None, 0
            for batch in batches:
                for id_, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if state is None or id_ != conv:
                        if state is not None:
                            yield from ((conv, number, *w) for w in state.end())
                        conv, state, number = id_, Windows(budget, history), 0
                    for w in state.add(Turn.of(role, text)):
                        yield conv, number, *w
                        number += 1
            if state is not None:
                yield from ((conv, number, *w) for w in state.end())

        yield from _batches(rows(), _WINDOWS)

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartition(parts, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return given.mapInArrow(run, _WINDOW_KINDS)


_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_windows", pa.int64()),
    ]
)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows hold, read from their text and loss spans alone: one row for each
    conversation with digests of its turns and of the text under the loss.

    Takes the result of ``windows`` as it is: the windows of a conversation follow each other
    in one partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conv, held = None, None
            for batch in batches:
                names = ("conv_id", "formatted", "loss_starts", "loss_ends", "repeated")
                for id_, text, starts, ends, repeated in zip(
                    *(batch.column(n).to_pylist() for n in names), strict=True
                ):
                    if held is None or id_ != conv:
                        if held is not None:
                            yield conv, *held.row()
                        conv, held = id_, _Digest()
                    held.add(text, starts, ends, repeated)
            if held is not None:
                yield conv, *held.row()

        yield from _batches(rows(), _DIGESTS)

    kinds = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long, n_windows long"
    )
    return formatted.mapInArrow(run, kinds)


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_windows = 0

    def add(self, text: str, starts: list[int], ends: list[int], repeated: int) -> None:
        self.chars += len(text)
        self.n_windows += 1
        for role, own, _ in parse(text)[repeated:]:
            self.turns.update(f"{role}\n{own}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1
        for start, end in zip(starts, ends, strict=True):
            target = unescape(text[start:end])
            self.loss_chars += len(target)
            self.loss.update(target.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        turns, loss = self.turns.hexdigest(), self.loss.hexdigest()
        return self.n_turns, turns, self.loss_chars, loss, self.chars, self.n_windows
