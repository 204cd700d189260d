"""Periodic runs of words: maximal stretches that repeat with a smallest period at least twice.

Each text is a sequence of words ``[^\\x20\\x09-\\x0D]+``, compared by 64-bit hashes. Texts are dealt to
tasks as they lie in the table; within a task a bounded slice of documents is worked on at once:

* *Longest common extensions* (how far the words from two places on agree) from a difference cover:
  only the suffixes at places of ``COVER`` modulo ``MODULUS`` are sorted, document by document, by
  words first and then by doubling. Any two places reach two such places after the same few words,
  which are compared one by one; the rest is a range minimum over the neighbours' common prefixes
  in a sparse table. Extensions to the left use the reversed sequence.
* *Harmonic grid*: a run of period ``q`` holds two neighbouring places of the grid ``0, q, 2q, ..``
  with the same word, so the ``n / q`` neighbours on each grid, ``n log n`` in all, are enough:
  extended to both sides they give every run. Of the periods of one stretch the least is kept.

Nothing crosses documents, so there is no shuffle at all. Memory is in proportion to a slice of 256 KB
or to the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.words import Hasher, Slice, slices

MIN_LENGTH = 12
#: A perfect difference set, every difference modulo 31 once.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
PAIRS = 1 << 18
_WORD = Hasher(93)
#: Of each difference ``d`` the place ``a`` with ``a`` and ``a + d`` in the cover.
_FIRST_OF = np.zeros(MODULUS, np.int64)
for _a in COVER:
    for _b in COVER:
        _FIRST_OF[(_b - _a) % MODULUS] = _a


def agreeing(x: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many words from ``i`` and ``j`` on agree, compared one by one up to ``limit``."""
    out = np.zeros(len(i), np.int64)
    open_ = np.arange(len(i))
    step = 0
    while len(open_):
        open_ = open_[limit[open_] > step]
        open_ = open_[x[i[open_] + step] == x[j[open_] + step]]
        step += 1
        out[open_] = step
    return out


def _refined(rank: np.ndarray, some: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Splits the groups of the suffixes ``some`` by what follows; returns those not yet alone.

    A group's rank is the place of its first suffix in the order.
    """
    order = np.lexsort((following, rank[some]))
    some, following = some[order], following[order]
    group = rank[some]
    new_group = np.concatenate(([True], group[1:] != group[:-1]))
    new = new_group | np.concatenate(([True], following[1:] != following[:-1]))
    at = np.arange(len(some))
    start = np.maximum.accumulate(np.where(new_group, at, 0))
    head = np.maximum.accumulate(np.where(new, at, 0))
    rank[some] = group + head - start
    lone = new & np.concatenate((new[1:], [True]))
    return some[~lone]


class CoverExtensions:
    """Longest common extensions to the right within documents of ``x``.

    ``x`` holds the words as numbers, and between and around documents numbers that occur once;
    ``doc`` is the document of each place, ascending.
    """

    def __init__(self, x: np.ndarray, doc: np.ndarray):
        self.x, n = x, len(x)
        in_cover = np.zeros(MODULUS, bool)
        in_cover[list(COVER)] = True
        places = np.flatnonzero(in_cover[np.arange(n) % MODULUS])
        index = np.full(n + 1, len(places), np.int64)  # of a place among the sampled ones
        index[places] = np.arange(len(places))
        padded = np.concatenate((x, np.full(MODULUS, -1, x.dtype)))
        own = doc[places]
        rank = np.searchsorted(own, own)
        some = np.arange(len(places))
        for step in range(MODULUS):
            if not len(some):
                break
            some = _refined(rank, some, padded[places[some] + step])
        levels = [rank.copy()]
        span = MODULUS
        while len(some):
            after = np.append(rank, -1)[index[np.minimum(places[some] + span, n)]]
            some = _refined(rank, some, after)
            levels.append(rank.copy())
            span *= 2
        order = np.empty(len(places), np.int64)
        order[rank] = places
        self._common(order, levels, index, own)
        self.rank = np.append(rank, 0)[index]

    def _common(self, order: np.ndarray, levels: list[np.ndarray], index: np.ndarray, own: np.ndarray) -> None:
        """The common prefix of each suffix with the one before it, and minima over ranges of these."""
        n = len(self.x)
        common = np.zeros(len(order), np.int64)
        if len(order) > 1:
            a, b = order[:-1], order[1:]
            length = np.zeros(len(a), np.int64)
            for level in range(len(levels) - 1, -1, -1):
                there = np.maximum(a, b) + length < n
                left, right = (index[np.minimum(p + length, n)] for p in (a, b))
                ranks = np.append(levels[level], -1)
                same = there & (ranks[left] == ranks[right])
                length[same] += MODULUS << level
            room = np.minimum(np.full(len(a), MODULUS), n - np.maximum(a, b) - length)
            common[1:] = length + agreeing(self.x, a + length, b + length, room)
        most = int(np.bincount(own).max()) if len(own) else 1  # ranges stay within a document
        self.table = [common]
        width = 1
        while 2 * width <= most:
            below = self.table[-1]
            self.table.append(np.minimum(below[:-width], below[width:]))
            width *= 2

    def synchronised(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words on both places are in the cover."""
        return (_FIRST_OF[(j - i) % MODULUS] - i) % MODULUS

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places ``i < j`` of one document."""
        shift = self.synchronised(i, j)
        out = agreeing(self.x, i, j, shift)
        rest = np.flatnonzero(out == shift)
        if len(rest):
            a, b = self.rank[i[rest] + shift[rest]], self.rank[j[rest] + shift[rest]]
            low, high = np.minimum(a, b) + 1, np.maximum(a, b)
            level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
            least = np.empty(len(rest), np.int64)
            for k in np.unique(level):
                at = level == k
                row = self.table[k]
                least[at] = np.minimum(row[low[at]], row[high[at] - (1 << k) + 1])
            out[rest] += least
        return out


def grid_pairs(starts: np.ndarray, counts: np.ndarray, pairs: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbours ``i, i + q`` on every grid of every document, about ``pairs`` at a time, as ``i, q``."""
    half = counts // 2
    before = np.cumsum(half) - half
    total = int(half.sum())
    doc = np.repeat(np.arange(len(counts)), half)
    q = np.arange(total) - np.repeat(before, half) + 1
    size = (counts[doc] - 1) // q
    ends = np.cumsum(size)
    low = 0
    while low < total:
        done = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + pairs, "right")))
        n = size[low:high]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        period = np.repeat(q[low:high], n)
        yield np.repeat(starts[doc[low:high]], n) + nth * period, period
        low = high


def _numbered(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as numbers with a number of its own at each border; the borders; starts of documents.

    Document ``d`` lies between the borders ``d`` and ``d + 1``.
    """
    counts = np.diff(first)
    docs = len(counts)
    starts = first[:-1] + np.arange(docs) + 1
    x = np.empty(len(words) + docs + 1, np.int64)
    borders = np.append(starts - 1, len(x) - 1)
    inside = np.ones(len(x), bool)
    inside[borders] = False
    numbers = np.unique(words, return_inverse=True)[1]
    x[inside] = numbers
    x[borders] = len(words) + np.arange(docs + 1)
    return x, borders, starts


def runs_of(words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, pairs: int = PAIRS) -> np.ndarray:
    """All runs of some documents, as rows of document, start, length, period, in this order.

    Document ``d`` has the words ``first[d]:first[d + 1]``; ``min_length`` is 3 at least.
    """
    x, borders, starts = _numbered(words, first)
    counts = np.diff(first)
    last = len(x) - 1
    right = left = None
    found = []
    for i, q in grid_pairs(starts, counts, pairs):
        same = np.flatnonzero(x[i] == x[i + q])
        # The words that agree around a grid place are two at least, and as many as the period.
        i, q = i[same], q[same]
        near = (x[i + 1] == x[np.minimum(i + q + 1, last)]) | (x[i - 1] == x[i + q - 1])
        i, q = i[near], q[near]
        if not len(i):
            continue
        if right is None:
            # The border that ends a document, on the right or on the left, belongs to it.
            at = np.arange(len(x))
            right = CoverExtensions(x, np.searchsorted(borders, at, "left"))
            left = CoverExtensions(x[::-1], (len(borders) - np.searchsorted(borders, at, "right"))[::-1])
        ahead = right(i, i + q)
        back = left(last - i - q + 1, last - i + 1)
        length = back + ahead + q
        good = length >= np.maximum(min_length, 2 * q)
        rows = np.stack((i - back, length, q), 1)[good]
        if len(rows):
            found.append(_least_periods(rows))
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = _least_periods(np.concatenate(found))
    of = np.searchsorted(borders, rows[:, 0]) - 1
    rows = np.column_stack((of, rows[:, 0] - starts[of], rows[:, 1], rows[:, 2]))
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _least_periods(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.concatenate(([True], np.any(rows[1:, :2] != rows[:-1, :2], axis=1)))
    return rows[new]


def _kept(part: Slice, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: words behind the first period of a run go."""
    change = np.zeros(len(part.starts) + 1, np.int64)
    base = part.first[runs[:, 0]] + runs[:, 1]
    np.add.at(change, base + runs[:, 3], 1)
    np.add.at(change, base + runs[:, 2], -1)
    return np.cumsum(change[:-1]) == 0


def joined_words(part: Slice, stays: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words that stay, one space after each, and the bounds of each document in that."""
    starts, sizes = part.starts[stays], (part.ends - part.starts)[stays] + 1
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    out = np.append(part.data, np.uint8(32))[np.minimum(at, len(part.data))]
    out[ends - 1] = 32
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(stays)))[part.first]]
    return out.tobytes(), bounds


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``id, n_words, runs, collapsed`` of every row.

    ``runs`` holds ``start, length, period`` (in words, from 0) of every stretch with a smallest period
    ``period`` and at least ``max(min_length, 2 * period)`` words that no neighbour extends, by start and
    period. ``collapsed`` is the words, joined by one space, without those that some run holds behind its
    first ``period`` words. A null text has no words; it and texts without words or runs have no runs,
    and ``collapsed`` is never null. Ids are passed as they are, null and repeated ones too; other
    columns are left out. An empty table gives an empty table. ``min_length`` is 3 at least.
    """
    if min_length < 3:
        raise ValueError("min_length must be 3 or more")
    rows = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                found = runs_of(_WORD(part.data, part.starts, part.ends), part.first, min_length)
                raw, bounds = joined_words(part, _kept(part, found))
                n = len(part.rows)
                offsets = pa.array(np.searchsorted(found[:, 0], np.arange(n + 1)).astype(np.int32))
                fields = [pa.array(np.ascontiguousarray(found[:, k])) for k in (1, 2, 3)]
                runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, ["start", "length", "period"]), type=run_type)
                bounds = bounds.tolist()
                texts = pa.array([raw[a : max(a, b - 1)] for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()).cast(pa.string())
                ids = batch.column(0).slice(part.rows.start, n)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(part.first).astype(np.int64)), runs, texts], names=["_id", "n_words", "runs", "collapsed"]
                )

    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id)
