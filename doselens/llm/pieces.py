"""Cutting texts by the pattern of a byte-level tokenizer, and remembering results for pieces."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import regex

REMEMBERED_LENGTH = 64
"""Results of longer pieces are not remembered."""
RUN = 50_000
"""Pieces handled at once, and the length from which a text is cut in parts."""


@lru_cache(maxsize=4)
def cutters(pattern: str) -> tuple[re.Pattern, regex.Pattern]:
    """The pattern for texts of Latin-1 characters alone, and for all texts.

    The first names its characters instead of their properties, which the
    standard library matches about twice as fast.
    """
    latin = [chr(i) for i in range(256)]
    spaces = "".join(c for c in latin if regex.fullmatch(r"\p{White_Space}", c))
    members = {
        r"\p{L}": "".join(c for c in latin if unicodedata.category(c)[0] == "L"),
        r"\p{N}": "".join(c for c in latin if unicodedata.category(c)[0] == "N"),
        r"\s": spaces,
    }

    def named(match: re.Match) -> str:
        found = match[0]
        if found[0] == "[":
            for name, characters in members.items():
                found = found.replace(name, re.escape(characters))
            return found
        if found == r"\S":
            return f"[^{re.escape(spaces)}]"
        return f"[{re.escape(members[found])}]"

    plain = re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\[sS]", named, pattern)
    return re.compile(plain), regex.compile(pattern)


def cut(text: str, pattern: str) -> Iterator[list[str]]:
    """The pieces of a text, in runs, so that a very long text is never cut as a whole."""
    latin, whole = cutters(pattern)
    try:
        text.encode("latin-1")
        used = latin
    except UnicodeEncodeError:
        used = whole
    if len(text) <= RUN:
        yield used.findall(text)
        return
    matches = used.finditer(text)
    while pieces := [match[0] for match in islice(matches, RUN)]:
        yield pieces


class Remembered:
    """Results of a function of pieces, in two generations of bounded size."""

    def __init__(self, function: Callable[[str], bytes], size: int) -> None:
        self.function, self.size = function, size
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def joined(self, pieces: list[str]) -> bytes:
        """The results of all pieces, one after the other."""
        if len(self.known) > self.size:
            self.older, self.known = self.known, {}
        known = self.known
        found = list(map(known.get, pieces))
        for i in [i for i, result in enumerate(found) if result is None]:
            piece = pieces[i]
            result = known.get(piece) or self.older.get(piece) or self.function(piece)
            if len(piece) <= REMEMBERED_LENGTH:
                known[piece] = result
            found[i] = result
        return b"".join(found)
