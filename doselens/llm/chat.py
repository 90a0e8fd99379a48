"""Chat formatting: conversations as windows of whole turns within a token budget.

A window holds the system turn, some turns repeated from before, and new turns. Prefix
sums of the turns' tokens decide how many new turns fit and how far back the repeated
ones may begin. Text under the loss mask is that of the assistant's new turns, so each
is learned once, however often it is repeated as history.

Turns stand between control strings; the same strings inside a text or role get one
backslash more after their first character, which reading takes away again.

Rows are streamed in the order of conversation and turn; a task holds one window and
its history, whatever the length of the conversation. A conversation is worked on by
one task, since its turns follow one another: a third of all rows in one conversation is
a stream of that length, not a group held at once.

Null texts and roles are empty. Rows without conversation id are one conversation. Equal
turn numbers are ordered by role and text (nulls first), and repeated rows stay. A turn
is never cut: one above the budget has a window with what history fits, if any. A system
turn above half of the budget is not repeated. Only a system turn that comes first is kept
for all windows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doselens.llm.common import ROWS_AT_ONCE

BEGIN, HEAD, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"([<\[])(\\*)((?:/?s>)|(?:/?INST\]))"
"""A control string with any number of backslashes after its first character."""
CONTROLS = re.compile(CONTROL)
ESCAPED = re.compile(r"([<\[])\\(\\*)((?:/?s>)|(?:/?INST\]))")
TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)

BUDGET = 2048
"""Tokens of a window."""
HISTORY_TOKENS = 512
"""Tokens of a window that turns of earlier windows may take."""
HISTORY_TURNS = 4
"""Turns of earlier windows that a window may repeat, besides the system turn."""
CHARS_AT_ONCE = 1 << 22
"""Characters of the windows that are sent on together."""

WINDOWS = (
    "conv_id bigint, window int, text string, loss array<struct<start:bigint,end:bigint>>, "
    "repeated int, n_tokens bigint"
)
READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, n_windows bigint"
)

Counter = Callable[[], Callable[[str], int]]
"""Called once in each task; what it gives counts the tokens of a text."""


def escape(text: str) -> str:
    return CONTROLS.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


@dataclass(frozen=True)
class Turn:
    role: str
    head: str
    body: str
    tokens: int

    @classmethod
    def of(cls, role: str, text: str, count: Callable[[str], int]) -> Turn:
        head, body = f"{BEGIN}{HEAD}{escape(role)}{BODY}", escape(text)
        return cls(role, head, body, count(f"{head}{body}{END}"))


@dataclass
class Windows:
    """Makes the windows of one conversation from its turns, one by one."""

    budget: int
    history_tokens: int
    history_turns: int
    system: Turn | None = None
    seen: int = 0
    made: int = 0
    held: list[Turn] = field(default_factory=list)
    """Turns that may still be repeated, then the new ones."""
    old: int = 0
    """How many of the held turns have been in a window."""
    sums: list[int] = field(default_factory=lambda: [0])
    """Tokens before each held turn, and of all."""

    @property
    def fixed(self) -> int:
        """Tokens of the system turn, where it is repeated."""
        return self.system.tokens if self.system and self.made else 0

    def add(self, turn: Turn) -> Iterator[tuple]:
        """Takes a turn; gives the window that it no longer fits into."""
        if len(self.held) > self.old:
            if self.fixed + self.sums[-1] + turn.tokens > self.budget:
                yield self.close()
        if len(self.held) == self.old:
            self._shorten(turn)
        if not self.seen and turn.role == "system" and 2 * turn.tokens <= self.budget:
            self.system = turn
        self.seen += 1
        self.held.append(turn)
        self.sums.append(self.sums[-1] + turn.tokens)

    def _shorten(self, turn: Turn) -> None:
        """Lets go the turns before the history that a window starting with ``turn`` repeats."""
        room = min(self.history_tokens, self.budget - self.fixed - turn.tokens)
        first = max(0, self.old - self.history_turns, bisect_left(self.sums, self.sums[-1] - room))
        first = self.old if room < 0 else min(first, self.old)
        if first < self.old and self.made and self.held[first] is self.system:
            first += 1
        self.held = self.held[first:]
        self.sums = [s - self.sums[first] for s in self.sums[first:]]
        self.old -= first

    def close(self) -> tuple:
        """The window of the held turns: number, text, loss spans, repeated turns, tokens."""
        again = [self.system] if self.system and self.made else []
        parts, loss, at = [], [], 0
        for place, turn in enumerate(again + self.held):
            start = at + len(turn.head)
            at = start + len(turn.body) + len(END)
            parts += [turn.head, turn.body, END]
            if place >= len(again) + self.old and turn.role == "assistant":
                loss.append({"start": start, "end": start + len(turn.body)})
        made = (self.made, "".join(parts), loss, len(again) + self.old, self.fixed + self.sums[-1])
        self.made += 1
        self.old = len(self.held)
        return made


def _batches(rows: Iterator[tuple], schema: pa.Schema, length: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a bounded number of rows and characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += length(row)
        if len(held) >= ROWS_AT_ONCE or size >= CHARS_AT_ONCE:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_WINDOWS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int32()),
        ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("repeated", pa.int32()),
        ("n_tokens", pa.int64()),
    ]
)
_READ = pa.schema(
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


def format_windows(
    conversations: DataFrame,
    counter: Counter,
    budget: int = BUDGET,
    history_tokens: int = HISTORY_TOKENS,
    history_turns: int = HISTORY_TURNS,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The windows of all conversations: text, loss spans, and how many turns are repeated.

    The windows of a conversation come together and in order. Spans count code points.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        count = counter()
        open_key, made = None, None
        for batch in batches:
            for name, own_role, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if made is None or name != open_key:
                    if made:
                        yield (open_key, *made.close())
                    open_key, made = name, Windows(budget, history_tokens, history_turns)
                for window in made.add(Turn.of(own_role or "", value or "", count)):
                    yield (open_key, *window)
        if made:
            yield (open_key, *made.close())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(windows(batches), _WINDOWS, lambda row: len(row[2]))

    chosen = conversations.select(
        F.col(key).cast("bigint").alias("k"), F.col(role).alias("r"), F.col(text).alias("x"), F.col(turn).alias("t")
    )
    ordered = chosen.repartition("k").sortWithinPartitions("k", "t", "r", "x")
    return ordered.select("k", "r", "x").mapInArrow(run, WINDOWS)


def turns_of(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a window."""
    return [(unescape(role), unescape(body)) for role, body in TURN.findall(text)]


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, found from them alone.

    The windows of a conversation must come together and in order, as
    ``format_windows`` gives them.
    """

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        open_key, started = None, False
        for batch in batches:
            rows = (batch.column(n).to_pylist() for n in ("conv_id", "text", "loss", "repeated"))
            for name, value, loss, repeated in zip(*rows, strict=True):
                if not started or name != open_key:
                    if started:
                        yield (open_key, n, turns.hexdigest(), learned, under.hexdigest(), length, made)
                    open_key, started = name, True
                    turns, under = hashlib.sha256(), hashlib.sha256()
                    n = learned = length = made = 0
                for own_role, body in turns_of(value)[repeated:]:
                    turns.update(f"{own_role}\n{body}\n".encode())
                    n += 1
                for span in loss:
                    body = unescape(value[span["start"] : span["end"]])
                    under.update(body.encode())
                    learned += len(body)
                length += len(value)
                made += 1
        if started:
            yield (open_key, n, turns.hexdigest(), learned, under.hexdigest(), length, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(conversations(batches), _READ, lambda row: 0)

    return windows.mapInArrow(run, READ)


def word_counter() -> Callable[[str], int]:
    """Counts words, where no vocabulary is at hand."""
    return lambda text: len(text.split())


def library_counter(path: str, pattern: str) -> Counter:
    """Counts the tokens of a byte-level vocabulary."""

    def prepare() -> Callable[[str], int]:
        from doselens.llm.shards import library_encoder

        encoder = library_encoder(path, pattern)
        width = int(encoder.id_type[2])
        return lambda text: len(encoder.encode(text)) // width

    return prepare
