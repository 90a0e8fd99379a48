"""Code points of texts as arrays, with everything but letters blanked out."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

CHUNK = 1 << 21


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def letter_runs(text: str, context: int) -> Iterator[tuple[np.ndarray, slice]]:
    """Parts of the lower-cased text as code points, 0 for what is no letter.

    Each part has ``context`` places before and after its own ones, which the
    slice names; beyond the ends of the text they are 0. A long text comes in
    several parts, so memory does not grow with it.
    """
    lowered = text.lower()
    for start in range(0, len(lowered), CHUNK):
        stop = min(start + CHUNK, len(lowered))
        first, last = max(0, start - context), min(len(lowered), stop + context)
        points = np.frombuffer(lowered[first:last].encode("utf-32-le", "surrogatepass"), "<u4")
        part = np.zeros(stop - start + 2 * context, np.uint32)
        at = context - (start - first)
        part[at : at + len(points)] = np.where(_is_letter()[points], points, 0)
        yield part, slice(context, context + stop - start)
