"""Token counts by a Viterbi search that keeps scores and counts alone.

The vocabulary of a SentencePiece model, read as a unigram vocabulary, is
compiled into an Aho-Corasick automaton. It lists every piece that ends at each
place of a text, longest first; dynamic programming keeps for each place the
best score and the number of pieces on the way there, and no path. The rules are
those of the library's unigram search: a later candidate replaces an earlier one
only if its score is higher, so of equal scores the longest last piece wins; a
character without a piece of its own may be unknown at ten below the lowest
score, and then counts its bytes if the model falls back to bytes.

A piece that was given a score to keep it from being made (``SENTINEL`` or less)
counts as one below the lowest other score.

Where no piece reaches across the beginning of a word, a text is counted word by
word and words met before are remembered.

Null and empty texts have no tokens and score 0. Repeated rows are counted one
by one. Texts are handled whole; memory holds one text and bounded tables.
"""

from __future__ import annotations

from functools import lru_cache
from math import inf

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from doselens.llm.common import BatchFunction, add_columns, texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 150_000
"""Words remembered before a new generation begins; the last one stays known."""
REMEMBERED_LENGTH = 64
SENTINEL = -1e8


class Counter:
    """Counts the pieces of the best segmentation."""

    def __init__(self, model: str) -> None:
        self.library = SentencePieceProcessor(model_file=model)
        library, size = self.library, self.library.get_piece_size()
        special = (library.is_unknown, library.is_control, library.is_byte, library.is_unused)
        self.automaton = ahocorasick.Automaton()
        scores = {
            library.id_to_piece(i): library.get_score(i)
            for i in range(size)
            if not any(test(i) for test in special)
        }
        lowest = min((score for score in scores.values() if score > SENTINEL), default=0.0)
        held = min(scores.values(), default=0.0) <= SENTINEL
        self.unknown = lowest - held - UNKNOWN_PENALTY
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), max(score, lowest - held)))
        self.automaton.make_automaton()
        self.bytes = any(library.is_byte(i) for i in range(size))
        across = any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in scores)
        self.words = regex.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.apart = not across
        self.known: dict[str, tuple[int, float]] = {}
        self.older: dict[str, tuple[int, float]] = {}

    def count(self, text: str) -> tuple[int, float]:
        """The number of pieces and the score of the best segmentation."""
        normal = self.library.normalize(text)
        if not normal:
            return 0, 0.0
        if not self.apart:
            return self._search(normal)
        total, score = 0, 0.0
        known = self.known.get
        for match in self.words.finditer(normal):
            n, added = known(match[0]) or self._remember(match[0])
            total += n
            score += added
        return total, score

    def _remember(self, word: str) -> tuple[int, float]:
        found = self.older.get(word) or self._search(word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self.known) >= REMEMBERED:
                self.older = dict(self.known)
                self.known.clear()
            self.known[word] = found
        return found

    def _search(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best segmentation of a word."""
        scores = [0.0, *[-inf] * len(word)]
        counts = [0] * (len(word) + 1)
        closed = single = 0

        def close(upto: int) -> None:
            """Gives places their last candidate: an unknown character."""
            nonlocal closed
            while closed < upto:
                closed += 1
                score = scores[closed - 1] + self.unknown
                if single != closed and score > scores[closed]:
                    scores[closed] = score
                    added = len(word[closed - 1].encode()) if self.bytes else 1
                    counts[closed] = counts[closed - 1] + added

        for last, (length, piece) in self.automaton.iter(word):
            if closed < last:
                close(last)
            end = last + 1
            score = scores[end - length] + piece
            if score > scores[end]:
                scores[end], counts[end] = score, counts[end - length] + 1
            if length == 1:
                single = end
        close(len(word))
        return counts[-1], scores[-1]


@lru_cache(maxsize=2)
def counter(model: str) -> Counter:
    """The counter of a Python worker, which goes on with it in its next tasks."""
    return Counter(model)


def add_counts(frame: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Adds ``n_tokens`` and ``best_score``; ``model`` is a file on every executor."""

    def prepare() -> BatchFunction:
        own = counter(model)

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [own.count(t) for t in texts(batch, text)]
            return [
                pa.array([n for n, _ in found], pa.int64()),
                pa.array([score for _, score in found], pa.float64()),
            ]

        return run

    return add_columns(frame, "n_tokens bigint, best_score double", prepare)
