"""Words of many texts at once, as byte ranges, and their hashes."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from marquee.llm.common import text_buffer

# Bytes of words: all but ASCII white space; or letters, digits and everything beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
LONG_WORD = 512


class Words(NamedTuple):
    """Word i is ``data[start[i] : start[i] + length[i]]``; those of text j are ``first[j] : first[j + 1]``.

    ``data`` holds the words joined by single spaces.
    """

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    def span(self, low: int, high: int) -> bytes:
        """The words from ``low`` to before ``high``, which are of one text, joined by one space."""
        if low >= high:
            return b""
        return self.data[self.start[low] : self.start[high - 1] + self.length[high - 1]].tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array, kind: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    data, bounds = text_buffer(texts)
    if lower:
        data = LOWER[data]
    inside = kind[data]
    n = len(data)
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    before[bounds] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(n + 1, bool)
    after[:-1] = inside
    after[bounds] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    first = np.searchsorted(starts, bounds)
    keep = np.zeros(n + 1, bool)
    keep[:-1] = inside
    keep[ends] = True
    place = np.zeros(n + 1, np.int64)
    np.cumsum(keep[:-1], out=place[1:])
    spaced = np.where(inside, data, np.uint8(0x20))[keep[:-1]]
    return Words(spaced, place[starts], ends - starts, first)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    n = len(words.start)
    h = words.length.astype(np.uint64) * _A + _C
    if not n:
        return h
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    some, at, left = np.arange(n), words.start, words.length
    long = np.flatnonzero(words.length > LONG_WORD)
    if len(long):
        some = np.flatnonzero(words.length <= LONG_WORD)
        at, left = at[some], left[some]
    while len(some):
        x = h[some] ^ (eight[at] & _MASK[np.minimum(left, 8)])
        x = x * _B
        h[some] = (x ^ (x >> np.uint64(29))) * _A
        more = left > 8
        some, at, left = some[more], at[more] + 8, left[more] - 8
    for i in long.tolist():
        h[i] = int.from_bytes(hashlib.blake2b(words.span(i, i + 1), digest_size=8).digest(), "little")
    return mix(h)


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in their order."""
    return mix(a * _A + (b ^ _C))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Entry i: the hash of words i to i + n - 1, whatever text they are of; n - 1 fewer entries than words."""
    if len(hashes) < n:
        return hashes[:0]
    out, have, block, width = None, 0, hashes, 1
    while True:  # by the binary digits of n
        if n & width:
            part = block[have : have + len(hashes) - n + 1]
            out = part if out is None else chain(out[: len(part)], part)
            have += width
        if width * 2 > n:
            return out if n > 1 else mix(out)
        block = chain(block[:-width], block[width:])
        width *= 2
