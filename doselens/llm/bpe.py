"""Byte-level BPE as a finite-state transducer, and streaming decoding.

A text is cut into pieces by a pattern and each piece is encoded by itself. The
merges are compiled into a non-deterministic transducer over bytes: a state is
the last finished token and a place in the trie of tokens, and a token may
follow another only if the merges keep the two apart. A sequence of tokens is
the result of the merges exactly when each neighbouring pair is. The transducer
is made deterministic while it runs: a state is then the set of readings still
possible with their output not yet agreed on, and output is emitted as soon as
all readings share it. A reading dies after at most the longest token, so the
lookahead is bounded by that length. States are made when first needed and
dropped together beyond a limit, so memory is bounded.

Null and empty texts have no ids and decode to the empty text. Ties cannot
occur: one reading of a piece is the right one. Repeated rows stay repeated.
Ids travel as packed little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from doselens.llm.common import BatchFunction, add_columns, texts
from doselens.llm.pieces import RUN, Remembered, cut

STATE_LIMIT = 160_000
"""States of the transducer kept at once in a task."""
PIECE_LIMIT = 160_000
"""Pieces met before a new generation of remembered ones begins; the last one stays known."""
def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Transducer:
    """Encodes pieces by the ranks of their tokens."""

    def __init__(self, ranks: dict[bytes, int], state_limit: int = STATE_LIMIT) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.packed = {rank: rank.to_bytes(4, "little") for rank in self.bytes_of}
        self.state_limit = state_limit
        self.halves: dict[int, tuple[int, int]] = {}
        self.apart: dict[int, bool] = {}
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner: set[int] = {0}
        for token, rank in ranks.items():
            if len(token) > 1:
                halves = self.merge(token, stop=2)
                if len(halves) != 2 or self.bytes_of[halves[0]] + self.bytes_of[halves[1]] != token:
                    continue  # the merges never produce it, so no reading has it
                self.halves[rank] = (halves[0], halves[1])
            node = 0
            for byte in token:
                self.inner.add(node)
                node = self.child.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node] = rank
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.readings: list[tuple] = []
        self.moves: dict[int, tuple[int, bytes]] = {}
        self.last: list[bytes] = []
        self._state((b"", -1, 0))

    def _state(self, readings: tuple) -> int:
        found = self.number.get(readings)
        if found is None:
            found = self.number[readings] = len(self.readings)
            self.readings.append(readings)
            ended = [readings[i] for i in range(0, len(readings), 3) if readings[i + 2] == 0]
            self.last.append(ended[0] if ended else b"")
        return found

    def merge(self, piece: bytes, stop: int = 1) -> list[int]:
        """The merges as defined, until ``stop`` parts are left or none applies.

        Neighbours of the lowest rank are joined, leftmost first.
        """
        parts = [piece[i : i + 1] for i in range(len(piece))]
        none = len(self.ranks) + 256
        while len(parts) > stop:
            ranks = [self.ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def _may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > 2 * self.state_limit:
                self.apart.clear()
            known = self.apart[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens never join across their border.

        The merges are undone from the latest on. At each step the parts at the
        border must not be a pair that would have been joined before the merge
        just undone; of equal ranks the one further left goes first.
        """
        before = len(self.ranks) + 256
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < before:
                return False
            later_left = left > right
            halves = self.halves.get(left if later_left else right)
            if halves is None:  # bytes rank lowest, unless a vocabulary orders them otherwise
                later_left = not later_left
                halves = self.halves.get(left if later_left else right)
                if halves is None:
                    return True
            if later_left:
                before, left = left, halves[1]
            else:
                before, right = right + 1, halves[0]

    def _move(self, state: int, byte: int) -> tuple[int, bytes]:
        """The next state and what is emitted, worked out once."""
        child, token_at, inner, apart = self.child.get, self.token, self.inner, self.apart
        readings = iter(self.readings[state])
        following: list = []
        shortest = None
        for out, last, node in zip(readings, readings, readings, strict=True):
            after = child(node << 8 | byte)
            if after is None:
                continue
            token = token_at[after]
            if token >= 0:
                follows = last < 0 or apart.get(last << 32 | token)
                if follows is None:
                    follows = self._may_follow(last, token)
                if follows:
                    following += (out + self.packed[token], token, 0)
            if after in inner:
                following += (out, last, after)
            elif token < 0 or not follows:
                continue
            if shortest is None or len(out) < len(shortest):
                shortest = following[-3]
        emitted = b""
        if shortest:
            agreed = len(shortest)
            for out in following[::3]:
                while out[:agreed] != shortest[:agreed]:
                    agreed -= 4
            if agreed:
                emitted = shortest[:agreed]
                following[::3] = [out[agreed:] for out in following[::3]]
        move = self._state(tuple(following)), emitted
        self.moves[state << 8 | byte] = move
        return move

    def encode(self, piece: bytes) -> bytes:
        """The packed ids of a piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return self.packed[whole]
        if len(self.readings) > self.state_limit:
            self._reset()
        state, out, moves = 0, [], self.moves
        for byte in piece:
            try:
                state, emitted = moves[state << 8 | byte]
            except KeyError:
                state, emitted = self._move(state, byte)
                if len(self.readings) > 2 * self.state_limit:
                    # Only a very long piece gets here: go on with the open readings alone.
                    readings = self.readings[state]
                    self._reset()
                    state, moves = self._state(readings), self.moves
            if emitted:
                out.append(emitted)
        out.append(self.last[state])
        return b"".join(out)


class Encoder:
    """Encodes texts: cuts them by the pattern and remembers frequent pieces."""

    def __init__(
        self, transducer: Transducer, pattern: str, piece_limit: int = PIECE_LIMIT
    ) -> None:
        self.transducer = transducer
        self.pattern = pattern
        self.pieces = Remembered(lambda piece: transducer.encode(piece.encode()), piece_limit)

    def encode(self, text: str) -> bytes:
        """The packed ids of a text."""
        return b"".join(map(self.pieces.joined, cut(text, self.pattern)))


class Utf8Stream:
    """Decodes UTF-8 that arrives in parts.

    The state is the beginning of a character whose other bytes are missing, of
    three bytes at most. Bytes that can begin no character become U+FFFD.
    """

    def __init__(self) -> None:
        self.open = b""

    def feed(self, data: bytes) -> str:
        data = self.open + data
        keep = _unfinished(data)
        self.open = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


def _unfinished(data: bytes) -> int:
    """The length of an unfinished character at the end."""
    for back in range(1, min(3, len(data)) + 1):
        byte = data[-back]
        if byte >= 0xC0:
            length = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 0
            return back if back < length and _may_begin(data[-back:]) else 0
        if byte < 0x80:
            return 0
    return 0


def _may_begin(start: bytes) -> bool:
    """Whether a second byte, if there, is one that its first byte allows."""
    lowest = {0xE0: 0xA0, 0xF0: 0x90}.get(start[0], 0x80)
    highest = {0xED: 0x9F, 0xF4: 0x8F}.get(start[0], 0xBF)
    return start[0] >= 0xC2 and (len(start) < 2 or lowest <= start[1] <= highest)


def decode_stream(runs: Iterable[bytes], bytes_of: dict[int, bytes]) -> Iterator[str]:
    """The text of packed ids that arrive in runs; characters may span tokens and runs."""
    stream = Utf8Stream()
    for run in runs:
        ids = np.frombuffer(run, "<u4").tolist()
        yield stream.feed(b"".join(map(bytes_of.__getitem__, ids)))
    yield stream.close()


@lru_cache(maxsize=2)
def encoder(vocabulary: str, pattern: str, states: int, pieces: int) -> Encoder:
    """The encoder of a Python worker, which goes on with it in its next tasks."""
    return Encoder(Transducer(read_ranks(vocabulary), states), pattern, pieces)


@lru_cache(maxsize=2)
def tokens(vocabulary: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(vocabulary).items()}


def encode(
    frame: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    drop_text: bool = False,
    states: int = STATE_LIMIT,
    pieces: int = PIECE_LIMIT,
) -> DataFrame:
    """Adds the packed ids of a text column; ``vocabulary`` is a file on every executor.

    A Python worker keeps its tables for its next tasks, which saves time; ``states`` and
    ``pieces`` limit them.
    """

    def prepare() -> BatchFunction:
        own = encoder(vocabulary, pattern, states, pieces)

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            gc.disable()  # states hold no cycles, and walking them costs a tenth of the time
            try:
                return [pa.array([own.encode(t) for t in texts(batch, text)], pa.binary())]
            finally:
                gc.enable()

        return run

    return add_columns(frame, f"`{ids}` binary", prepare, [text] if drop_text else [])


def encode_and_decode(
    frame: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    drop_text: bool = False,
    states: int = STATE_LIMIT,
    pieces: int = PIECE_LIMIT,
) -> DataFrame:
    """Adds the packed ids of a text column and the text decoded from them.

    Both in one Python worker and with one table of the vocabulary, which goes with its
    task: for jobs whose executors have other work too.
    """

    def prepare() -> BatchFunction:
        own = Encoder(Transducer(read_ranks(vocabulary), states), pattern, pieces)
        bytes_of = own.transducer.bytes_of

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            gc.disable()  # as in ``encode``
            try:
                packed = [own.encode(t) for t in texts(batch, text)]
            finally:
                gc.enable()
            return [
                pa.array(packed, pa.binary()),
                pa.array([decoded_text(p, bytes_of) for p in packed], pa.string()),
            ]

        return run

    fields = f"`{ids}` binary, `{decoded}` string"
    return add_columns(frame, fields, prepare, [text] if drop_text else [])


def decoded_text(packed_ids: bytes | None, bytes_of: dict[int, bytes]) -> str:
    """The text of packed ids, which are decoded run by run."""
    data = packed_ids or b""
    runs = (data[i : i + 4 * RUN] for i in range(0, len(data), 4 * RUN))
    return "".join(decode_stream(runs, bytes_of))


def decode(
    frame: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded"
) -> DataFrame:
    """Adds the text of packed ids; null ids decode to the empty text."""

    def prepare() -> BatchFunction:
        bytes_of = tokens(vocabulary)
        return lambda batch: [
            pa.array([decoded_text(x, bytes_of) for x in batch.column(ids).to_pylist()], pa.string())
        ]

    return add_columns(frame, f"`{text}` string", prepare)
