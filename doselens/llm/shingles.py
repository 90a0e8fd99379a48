"""Sets of word shingles as sorted 64-bit hashes.

Words are what stands between ASCII white space, with A to Z in lower case. A
set holds the hash of each run of ``width`` words; a shorter text has one hash,
of all its words; a text without words has none. Different shingles have
different hashes but for a chance of about 2^-64 for each pair compared.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WIDTH = 5
SEGMENT = 1 << 18
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads every bit of 64-bit values over all of them."""
    values = values + np.uint64(salt & 0xFFFFFFFFFFFFFFFF)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, the powers of the base, and those of its inverse."""
    n = SEGMENT + 1
    values = mixed(np.arange(1, 257, dtype=np.uint64), 7)
    inverse = pow(_BASE, -1, 1 << 64)
    powers, back = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    powers[0] = back[0] = 1
    return values, np.cumprod(powers), np.cumprod(back)


def _segment_words(data: bytes) -> np.ndarray:
    """The hashes of the words of at most ``SEGMENT`` bytes: polynomials in the base."""
    values, powers, back = _powers()
    array = np.frombuffer(data, np.uint8)
    blank = np.concatenate([[True], _SPACE[array], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(array) + 1, np.uint64)
    np.cumsum(values[array] * powers[: len(array)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts], _BASE) + (ends - starts).astype(np.uint64)


def word_hashes(text: str) -> np.ndarray:
    """The hashes of the words of a text, in order."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    if len(data) <= SEGMENT:
        return _segment_words(data) if data else np.zeros(0, np.uint64)
    parts, start = [], 0
    blank = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8)])
    while start < len(data):
        stop = min(start + SEGMENT, len(data))
        if stop < len(data):
            at = int(np.searchsorted(blank, stop, "right")) - 1
            if at >= 0 and blank[at] > start:
                stop = int(blank[at])
            else:  # a word longer than a segment: hashed by itself
                following = blank[at + 1] if at + 1 < len(blank) else len(data)
                parts.append(_long_word(data[start : int(following)]))
                start = int(following)
                continue
        parts.append(_segment_words(data[start:stop]))
        start = stop
    return np.concatenate(parts)


def _long_word(data: bytes) -> np.ndarray:
    import xxhash

    word = data.strip(b" \t\n\x0b\x0c\r")
    return np.array([xxhash.xxh64_intdigest(word)], np.uint64)[: len(word) > 0]


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct hashes of the shingles of a text."""
    words = word_hashes(text)
    n = len(words)
    if n == 0:
        return words
    if n < width:
        total = np.uint64(n)
        for word in words:
            total = mixed(np.array([total ^ word]), n)[0]
        return np.array([total], np.uint64)
    joined = words[: n - width + 1].copy()
    for i in range(1, width):
        joined *= np.uint64(0xD6E8FEB86659FD93)
        joined += words[i : n - width + 1 + i] ^ np.uint64(i * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)
    joined = np.sort(mixed(joined, 11))
    fresh = np.ones(len(joined), bool)
    np.not_equal(joined[1:], joined[:-1], out=fresh[1:])
    return joined[fresh]
