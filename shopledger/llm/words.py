"""Words of whole texts as numpy arrays, one slice of documents at a time.

A word is a run of bytes other than space and ``\\x09-\\x0D`` in the UTF-8 text, that is
``[^\\x20\\x09-\\x0D]+``. Each byte is replaced by a fixed random 64-bit number; a word's hash is
the polynomial of its bytes, so that one prefix sum over a slice gives the hashes of all words.
Nothing here runs outside Spark tasks and no slice is larger than ``SLICE`` bytes or one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything but ASCII letters and the bytes of other characters.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[65:91] = NO_LETTER[97:123] = NO_LETTER[128:] = False
_U = np.uint64


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class SpanHasher:
    """Hashes of many spans of one array of 64-bit numbers from one prefix sum."""

    def __init__(self, seed: int):
        self._base = int(_random(seed, 1)[0])
        self._inverse = pow(self._base, -1, 1 << 64)
        self._powers(SLICE)

    def _powers(self, n: int) -> None:
        def powers(x: int) -> np.ndarray:
            out = np.full(n + 1, x, dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        self._up, self._down = powers(self._base), powers(self._inverse)

    def __call__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(values) >= len(self._up):
            self._powers(len(values))
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self._up[: len(values)], out=sums[1:])
        lengths = (ends - starts).astype(np.uint64)
        return mix((sums[ends] - sums[starts]) * self._down[starts] + lengths)


class Hasher:
    """One hash function for words; ``fold`` lower-cases A-Z."""

    def __init__(self, seed: int = 1, fold: bool = False):
        self._bytes = _random(seed, 256)
        if fold:
            self._bytes[65:91] = self._bytes[97:123]
        self._spans = SpanHasher(seed + 1)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._spans(self._bytes[data], starts, ends)


@dataclass
class Slice:
    """Some documents: their rows in the batch, their bytes, and where their words lie."""

    rows: range
    data: np.ndarray  # uint8
    bounds: np.ndarray  # document i has data[bounds[i]:bounds[i + 1]]
    starts: np.ndarray  # of words
    ends: np.ndarray
    doc: np.ndarray  # document of each word, from 0
    first: np.ndarray  # document i has the words first[i]:first[i + 1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls become empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def split_words(data: np.ndarray, bounds: np.ndarray, rows: range, between: np.ndarray = SPACE) -> Slice:
    space = between[data]
    first = ~space
    last = first.copy()
    word = first.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    if len(data):
        at = bounds[:-1][bounds[:-1] < len(data)]
        first[at] = word[at]
        at = bounds[1:][bounds[1:] > 0] - 1
        last[at] = word[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(bounds, starts, "right") - 1
    return Slice(rows, data, bounds, starts, ends, doc, np.searchsorted(starts, bounds))


def slices(column: pa.Array, size: int = SLICE, between: np.ndarray = SPACE) -> Iterator[Slice]:
    """The texts of a column, some documents at a time, with their words; ``between`` marks other bytes."""
    data, offsets = text_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        part = data[offsets[i] : offsets[j]]
        yield split_words(part, offsets[i : j + 1] - offsets[i], range(i, j), between)
        i = j


def window_hashes(h: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Hash of each ``k`` consecutive word hashes, across document borders too: mask those."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = _random(seed, k)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += h[j : j + n] * c[j]
    return mix(total)


def shingle_sets(part: Slice, h: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """Of each document the sorted distinct hashes of its ``k``-word shingles.

    With fewer than ``k`` words the whole sequence is one shingle; without words the set is empty.
    """
    whole = window_hashes(h, k)
    c = _random(8, k)
    for i in range(len(part.rows)):
        a, b = int(part.first[i]), int(part.first[i + 1])
        if b - a >= k:
            s = np.sort(whole[a : b - k + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            total = np.add.reduce(h[a:b] * c[: b - a], dtype=np.uint64) + _U(b - a)
            yield mix(np.array([total], dtype=np.uint64))
        else:
            yield whole[:0]
