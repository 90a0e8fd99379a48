"""Fill-in-the-middle: texts cut at unit boundaries and put in another order.

A text is cut twice at boundaries of its units (lines, sentences, words or
characters) and its prefix, middle and suffix are written behind markers, the middle
last. A wavelet matrix over the classes of a batch's characters answers both questions
this asks: how many units a text has (ranks of the classes that end a unit, added up),
and where the k-th unit ends (a select where one class ends units, otherwise a
bisection on the added ranks). One matrix serves all texts of a batch, so that its
arrays are long whatever the length of the texts.

Null texts are empty, and empty texts are plain. So are texts that hold a marker: they
could not be put together again. A null key is hashed as the empty text. Equal keys get
equal draws; repeated rows give equal results. A very long text is one batch of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doselens.llm.common import BatchFunction, add_columns, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

NEWLINE, BLANK, STOP, DIGIT, LETTER, OTHER = range(6)
"""Classes of characters."""
LEVELS = 3
"""Bits of a class."""
UNIT_ENDS = {
    "line": (NEWLINE,),
    "sentence": (NEWLINE, STOP),
    "word": (NEWLINE, BLANK),
    "character": (NEWLINE, BLANK, STOP, DIGIT, LETTER, OTHER),
}
"""The classes whose characters end a unit; what is left at the end of a text is a unit too."""
STOPS = ".!?…。！？"

CHARS_AT_ONCE = 1 << 21
"""Characters of a matrix, unless one text is longer."""

SEED = 7
FIM_PERCENT = 100
"""Texts of a hundred that are cut."""
SPM_PERCENT = 50
"""Cut texts of a hundred whose suffix comes first."""

RESULT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    found = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            found[i] = LETTER
        elif c.isdigit():
            found[i] = DIGIT
        elif c.isspace():
            found[i] = BLANK
    found[[ord(c) for c in STOPS]] = STOP
    found[ord("\n")] = NEWLINE
    return found


class Bits:
    """A row of bits with ranks and selects of many places at once."""

    def __init__(self, bits: np.ndarray) -> None:
        self.size = len(bits)
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((len(packed) // 8 + 1) * 8, np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view("<u8")
        self.ones = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.ones[1:])
        self.zeros = 64 * np.arange(len(self.ones), dtype=np.int64) - self.ones

    def rank(self, places: np.ndarray, bit: int) -> np.ndarray:
        """How many of the bits before each place equal ``bit``."""
        word, inside = places >> 6, (places & 63).astype(np.uint64)
        below = (np.uint64(1) << inside) - np.uint64(1)
        ones = self.ones[word] + np.bitwise_count(self.words[word] & below)
        return ones if bit else places - ones

    def select(self, numbers: np.ndarray, bit: int) -> np.ndarray:
        """The place of the ``numbers``-th bit, from 0, that equals ``bit``."""
        counts = self.ones if bit else self.zeros
        word = np.searchsorted(counts, numbers, side="right") - 1
        left = numbers - counts[word]
        held = self.words[word] if bit else ~self.words[word]
        place = np.zeros(len(numbers), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            mask = np.uint64((1 << width) - 1)
            below = np.bitwise_count(held >> place.astype(np.uint64) & mask).astype(np.int64)
            later = left >= below
            left = np.where(later, left - below, left)
            place = np.where(later, place + width, place)
        return 64 * word + place


class WaveletMatrix:
    """Ranks and selects of symbols of ``levels`` bits in a long row of them."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS) -> None:
        self.size = len(symbols)
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in reversed(range(levels)):
            ones = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(ones), self.size - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _down(self, symbol: int, places: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            bit = symbol >> shift & 1
            places = bits.rank(places, bit) + (zeros if bit else 0)
        return places

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        return self._down(symbol, places) - self._down(symbol, np.zeros(1, np.int64))

    def select(self, symbol: int, numbers: np.ndarray) -> np.ndarray:
        """The place of the ``numbers``-th occurrence, from 0, of the symbol."""
        places = numbers + self._down(symbol, np.zeros(1, np.int64))
        for shift, bits, zeros in reversed(self.levels):
            bit = symbol >> shift & 1
            places = bits.select(places - (zeros if bit else 0), bit)
        return places


class Boundaries:
    """The unit boundaries of several texts, from one matrix over all their characters."""

    def __init__(self, values: Sequence[str], ends: Sequence[int]) -> None:
        joined = "".join(values).encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(joined, "<u4")
        self.matrix = WaveletMatrix(_classes()[points])
        self.ends = tuple(ends)
        stops = np.cumsum([len(v) for v in values], dtype=np.int64)
        self.starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
        self.stops = stops
        self.before = self._ended(self.starts)
        self.closed = self._ended(self.stops) - self.before
        last = _classes()[points[np.maximum(stops, 1) - 1]] if len(points) else np.zeros(0, np.uint8)
        open_end = ~np.isin(last, self.ends) if len(points) else np.zeros(len(stops), bool)
        self.counts = self.closed + (open_end & (stops > self.starts))
        """Units of each text."""

    def _ended(self, places: np.ndarray) -> np.ndarray:
        """Units that end before each place."""
        return sum((self.matrix.rank(c, places) for c in self.ends), np.zeros(len(places), np.int64))

    def after(self, units: np.ndarray) -> np.ndarray:
        """The place in each text behind its first ``units`` units."""
        found = np.where(units > self.closed, self.stops, self.starts)
        asked = (units > 0) & (units <= self.closed)
        if asked.any():
            wanted = (self.before + units)[asked]
            if len(self.ends) == 1:
                found[asked] = self.matrix.select(self.ends[0], wanted - 1) + 1
            else:
                low, high = self.starts[asked], self.stops[asked]
                while (open_ones := low < high).any():
                    half = (low + high) >> 1
                    enough = self._ended(half) >= wanted
                    high = np.where(open_ones & enough, half, high)
                    low = np.where(open_ones & ~enough, half + 1, low)
                found[asked] = low
        return found - self.starts


@dataclass(frozen=True)
class Draw:
    """What the key of a document decides."""

    first: int
    second: int
    cut: int
    order: int

    @classmethod
    def of(cls, key: object, seed: int) -> Draw:
        digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
        return cls(*(int(digest[i : i + 8], 16) for i in range(0, 32, 8)))


def marked(text: str) -> bool:
    return any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))


def arranged(form: str, prefix: str, middle: str, suffix: str) -> str:
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def _runs(values: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded length together, or of one text."""
    start, length = 0, 0
    for i, value in enumerate(values):
        if i > start and length + len(value) > CHARS_AT_ONCE:
            yield start, i
            start, length = i, 0
        length += len(value)
    if start < len(values):
        yield start, len(values)


def infill(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    unit: str = "line",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """Adds the units, the form, the lengths of prefix and middle, and the new text."""
    ends = UNIT_ENDS[unit]

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        keys, values = batch.column(key).to_pylist(), texts(batch, text)
        counts, forms, prefixes, middles, outputs = [], [], [], [], []
        for start, stop in _runs(values):
            part = values[start:stop]
            draws = [Draw.of(k, seed) for k in keys[start:stop]]
            found = Boundaries(part, ends)
            first, second = (
                np.array([getattr(d, name) for d in draws], np.int64) % (found.counts + 1)
                for name in ("first", "second")
            )
            cuts = found.after(np.minimum(first, second)), found.after(np.maximum(first, second))
            for value, draw, a, b in zip(part, draws, *(c.tolist() for c in cuts), strict=True):
                if not value or marked(value) or draw.cut % 100 >= fim_percent:
                    form, a, b, output = "plain", None, None, value
                else:
                    form = "spm" if draw.order % 100 < spm_percent else "psm"
                    output = arranged(form, value[:a], value[a:b], value[b:])
                    b -= a
                forms.append(form)
                prefixes.append(a)
                middles.append(b)
                outputs.append(output)
            counts.extend(found.counts.tolist())
        longs = [pa.array(c, pa.int64()) for c in (counts, prefixes, middles)]
        return [longs[0], pa.array(forms, pa.string()), *longs[1:], pa.array(outputs, pa.string())]

    def prepare() -> BatchFunction:
        return run

    return add_columns(frame, RESULT, prepare)


def restore(output: Column, form: Column) -> Column:
    """The text of an output; each marker stands in it once."""

    def between(mark: str, end: str | None) -> Column:
        rest = F.substring_index(output, mark, -1)
        return F.substring_index(rest, end, 1) if end else rest

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
