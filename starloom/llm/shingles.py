"""Word shingles of a text as sets of 64-bit numbers.

Words are runs of anything but space, tab, line feed, vertical tab, form feed
and carriage return; the letters A-Z count as a-z.  A text's set holds its
distinct shingles of five words in a row; a text of one to four words has one
member, its whole sequence; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
#: Words remembered per Python worker; the table starts anew beyond it.
WORDS_KEPT = 100_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
NONE = np.zeros(0, np.uint64)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number


_numbers = _Numbers()


def words(text: str | None) -> list[bytes]:
    """On bytes, lower() and split() know ASCII letters and ASCII white space only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingles."""
    found = words(text)
    if not found:
        return NONE
    if len(found) < WIDTH:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), seed=len(found))], dtype=np.uint64)
    number = np.fromiter(map(_numbers.__getitem__, found), dtype=np.uint64, count=len(found))
    n = len(found) - WIDTH + 1
    out = number[:n].copy()
    for k in range(1, WIDTH):
        out *= _FACTOR
        out += number[k : n + k]
    out ^= out >> np.uint64(31)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return np.unique(out)


def set_key(members: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return xxhash.xxh3_128_digest(members.tobytes())
