"""Sets of word shingles of whole texts, as sorted 64-bit hashes.

Words are the runs between white space (space, tab to carriage return), as they
stand. A text with fewer words than a shingle has one shingle, all its words; a
text without words has none.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.hashing import Substrings, numbers, spread

PLACES = numbers(64, 2) | np.uint64(1)


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the texts in order, and each text's number of words."""
    data = b"\n".join(texts) + b"\n"
    found = Substrings(data)
    white = (found.bytes == 32) | ((found.bytes >= 9) & (found.bytes <= 13))
    before = np.concatenate(([True], white[:-1]))
    starts, ends = np.flatnonzero(~white & before), np.flatnonzero(white & ~before)
    borders = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, borders)
    return spread(found.hashes(starts, ends)), np.diff(upto, prepend=0)


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted."""
    words, counts = _words(texts)
    total = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        total += words[k : k + len(total)] * PLACES[k]
    total = spread(total)
    sets, at = [], 0
    for n in counts:
        if n >= size:
            own = total[at : at + n - size + 1]
            own = np.sort(own)
            keep = np.empty(len(own), bool)
            keep[:1] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        elif n:
            own = spread((words[at : at + n] * PLACES[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            own = np.empty(0, np.uint64)
        sets.append(own)
        at += n
    return sets
