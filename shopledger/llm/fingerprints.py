"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: runs of words that end with a line break or a sentence (full stops of
scripts without spaces end one inside a word, too). So that texts without such ends are not one
digest, a run also ends, from its eighth word on, at words that their hash chooses (one of eight), and
16 words after the last end at the latest; words longer than 256 bytes are cut every 256 bytes. The
same words thus mostly have the same cuts wherever they stand, and no digest stands for a long text.
Each paragraph
has a 64-bit digest (of its bytes and of how often the same paragraph came before in the text), and
each digest is added to three cells of a small table: a cell holds the number of its digests, their
XOR and the XOR of their checks. Two sketches of one size subtract cell by cell, what both texts have
cancels, and cells with a single digest are peeled off until nothing is left; then the differing
digests are known. If something is left, the sketches were too small, and both are built anew with
four times as many cells.

The likeness of two texts is the share of paragraphs that both have among all that either has.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.words import Hasher, Slice, mix, slices

CELLS = 18
TABLES = 3
GROWTH = 4
_HASH = Hasher(41)
_CHECK, _PLACE, _AGAIN = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)
_CELL = np.dtype([("count", "<i4"), ("digests", "<u8"), ("check", "<u4")])
_SENTENCE_END = np.zeros(256, dtype=bool)
_SENTENCE_END[list(b".!?")] = True
#: Full stops, question and exclamation marks of other scripts, as UTF-8.
_WIDE_ENDS = [np.frombuffer(c.encode(), np.uint8) for c in "。！？｡।۔؟።။"]
_FREE_WORDS, _CHOSEN, _MOST_WORDS, _MOST_BYTES = 8, np.uint64(7), 16, 256


def _inner_ends(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Where paragraphs end by other scripts' full stops or by length, in or after words, and those inside words."""
    data, found = part.data, [np.zeros(0, np.int64)]
    for mark in _WIDE_ENDS:
        here = np.flatnonzero(data[: len(data) - len(mark) + 1] == mark[0]) if len(data) >= len(mark) else found[0]
        for i in range(1, len(mark)):
            here = here[data[here + i] == mark[i]]
        found.append(here + len(mark))
    long = np.flatnonzero(part.ends - part.starts > _MOST_BYTES)
    for w in long:
        found.append(np.arange(part.starts[w] + _MOST_BYTES, part.ends[w], _MOST_BYTES))
    ends = np.unique(np.concatenate(found))
    word = np.searchsorted(part.starts, ends, "left") - 1
    return ends, ends[(word >= 0) & (ends < part.ends[word])]


def paragraphs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The digests of all paragraphs, and the row of each, in the order of rows."""
    digests, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in slices(column):
        if not len(part.starts):
            continue
        closed, inside = _inner_ends(part)
        starts, ends = np.sort(np.append(part.starts, inside)), np.sort(np.append(part.ends, inside))
        unit_doc = part.doc[np.searchsorted(part.starts, starts, "right") - 1]
        lines = np.concatenate(([0], np.cumsum(part.data == 10)))
        last = _SENTENCE_END[part.data[ends - 1]] | np.isin(ends, closed)
        new = np.ones(len(starts), bool)
        new[1:] = last[:-1] | (lines[starts[1:]] > lines[ends[:-1]]) | (unit_doc[1:] != unit_doc[:-1])
        at = np.arange(len(starts))
        chosen = (_HASH(part.data, starts, ends) & _CHOSEN) == 0
        new[1:] |= chosen[:-1] & ((at - np.maximum.accumulate(np.where(new, at, 0)))[1:] >= _FREE_WORDS)
        new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % _MOST_WORDS == 0
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(new)) - 1
        h, doc = _HASH(part.data, starts[first], ends[end]), unit_doc[first]
        # Equal paragraphs of a text are told apart by how many came before.
        order = np.lexsort((np.arange(len(h)), h, doc))
        same = np.zeros(len(h), bool)
        same[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        at = np.arange(len(h))
        nth = np.empty(len(h), np.uint64)
        nth[order] = at - np.maximum.accumulate(np.where(same, 0, at))
        digests.append(mix(h + nth * _AGAIN))
        rows.append(doc + part.rows.start)
    return np.concatenate(digests), np.concatenate(rows)


def _places(digests: np.ndarray, cells: int) -> list[np.ndarray]:
    each = cells // TABLES
    return [t * each + (mix(digests + np.uint64(t + 1) * _PLACE) % np.uint64(each)).astype(np.int64) for t in range(TABLES)]


def _checks(digests: np.ndarray) -> np.ndarray:
    return (mix(digests ^ _CHECK) >> np.uint64(32)).astype(np.uint32)


def _add(sketch: np.ndarray, digests: np.ndarray, rows: np.ndarray, signs: np.ndarray, cells: int) -> None:
    checks = _checks(digests)
    for place in _places(digests, cells):
        at = rows * cells + place
        np.add.at(sketch["count"], at, signs.astype(np.int32))
        np.bitwise_xor.at(sketch["digests"], at, digests)
        np.bitwise_xor.at(sketch["check"], at, checks)


class Sketch:
    """The columns of cells of ``n`` sketches, row after row."""

    def __init__(self, n: int, cells: int):
        self.cells = cells
        self.columns = {
            "count": np.zeros(n * cells, np.int32),
            "digests": np.zeros(n * cells, np.uint64),
            "check": np.zeros(n * cells, np.uint32),
        }

    def add(self, digests: np.ndarray, rows: np.ndarray, sign: int | np.ndarray = 1) -> Sketch:
        _add(self.columns, digests, rows, np.broadcast_to(sign, digests.shape), self.cells)
        return self

    def texts(self) -> list[str]:
        """Each sketch as base64 of its cells."""
        table = np.zeros(len(self.columns["count"]), _CELL)
        for name, values in self.columns.items():
            table[name] = values
        return [base64.b64encode(row.tobytes()).decode() for row in table.reshape(-1, self.cells)]

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Digests, rows and signs of all that can be peeled, and which rows came out empty."""
        c, found = self.columns, []
        todo = np.arange(len(c["count"]))
        while len(todo):
            pure = todo[np.abs(c["count"][todo]) == 1]
            pure = pure[_checks(c["digests"][pure]) == c["check"][pure]]
            if not len(pure):
                break
            digests, rows, signs = c["digests"][pure], pure // self.cells, c["count"][pure]
            order = np.lexsort((digests, rows))
            once = np.ones(len(order), bool)
            once[1:] = (digests[order][1:] != digests[order][:-1]) | (rows[order][1:] != rows[order][:-1])
            keep = order[once]
            digests, rows, signs = digests[keep], rows[keep], signs[keep]
            _add(c, digests, rows, -signs, self.cells)
            found.append((digests, rows, signs))
            todo = np.unique(np.concatenate([rows * self.cells + p for p in _places(digests, self.cells)]))
        left = ((c["count"] != 0) | (c["digests"] != 0)).reshape(-1, self.cells).any(1)
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), ~left
        return (*(np.concatenate(x) for x in zip(*found, strict=True)), ~left)


def differences(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int, cells: int = CELLS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests that only one of two texts has: digest, row, sign (1: only ``a``), and cells used by row.

    ``a`` and ``b`` are digests and rows as of ``paragraphs``. Rows whose sketches do not peel are
    taken up again with larger ones.
    """
    used, open_rows, out = np.full(n, cells), np.arange(n), []
    while len(open_rows):
        at = np.full(n, -1)
        # A few rows at a time, so that the cells in memory are bounded but for one long text.
        many = max(1, (1 << 20) // cells)
        failed = []
        for low in range(0, len(open_rows), many):
            some = open_rows[low : low + many]
            at[:] = -1
            at[some] = np.arange(len(some))
            sketch = Sketch(len(some), cells)
            for (digests, rows), sign in ((a, 1), (b, -1)):
                mine = at[rows] >= 0
                sketch.add(digests[mine], at[rows[mine]], sign)
            digests, rows, signs, whole = sketch.peel()
            good = whole[rows]
            out.append((digests[good], some[rows[good]], signs[good]))
            used[some] = cells
            failed.append(some[~whole])
        open_rows = np.concatenate(failed)
        cells *= GROWTH
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), used
    return (*(np.concatenate(x) for x in zip(*out, strict=True)), used)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Common paragraphs by all paragraphs of either text; 1 for two texts without any."""
    _, rows, _, _ = differences(a, b, n)
    differ = np.bincount(rows, minlength=n)
    total = np.bincount(a[1], minlength=n) + np.bincount(b[1], minlength=n)
    return np.where(total > 0, (total - differ) / np.maximum(total + differ, 1), 1.0)


def fingerprints(column: pa.Array) -> list[str]:
    """The base-size sketch of each text; a null text is an empty one."""
    return Sketch(len(column), CELLS).add(*paragraphs(column)).texts()


def compare(versions: DataFrame, before: str, after: str, keep: list[str]) -> DataFrame:
    """``keep`` with ``near, removed, added, cells``: how two text columns of a row differ.

    ``removed`` and ``added`` are the sorted digests of paragraphs that only the text before or after
    has, ``cells`` the size of sketch that was peeled. Null texts are empty ones; two empty texts are
    alike (1).
    """
    names = [*keep, "near", "removed", "added", "cells"]
    types = ", ".join(f"`{c}` {versions.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{types + ', ' if keep else ''}near double, removed array<bigint>, added array<bigint>, cells int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                n = part.num_rows
                a, b = paragraphs(part.column(n_keep)), paragraphs(part.column(n_keep + 1))
                digests, rows, signs, cells = differences(a, b, n)
                sides = []
                for sign in (1, -1):
                    side: list[list[int]] = [[] for _ in range(n)]
                    for d, r in zip(digests[signs == sign].view(np.int64).tolist(), rows[signs == sign], strict=True):
                        side[r].append(d)
                    sides.append(pa.array([sorted(s) for s in side], pa.list_(pa.int64())))
                near = pa.array(likeness(a, b, n))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_keep], near, *sides, pa.array(cells.astype(np.int32))], names=names
                )

    n_keep = len(keep)
    return versions.select(*keep, F.col(before).alias("_before"), F.col(after).alias("_after")).mapInArrow(run, schema)


def _bucket(id: Column, bounds: list[float]) -> Column:
    """How many of the sorted ``bounds`` are at most ``id``, by halving."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(id < bounds[mid], among(low, mid)).otherwise(among(mid + 1, high))

    return among(0, len(bounds))


def with_next(docs: DataFrame, id: str, text: str, parts: int | None = None) -> DataFrame:
    """Rows ``bucket, follows, id, tie, text``, by which each task can read documents in ascending order.

    Rows fall into ``parts`` ranges of ids (null ids into as many by the hash of their text, after
    all others), and the first row of each range is added to the range before as one that only
    follows; the first of all follows the last. One row per range goes through the driver.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = [i / parts for i in range(1, parts)]
    bounds = sorted(set(docs.select(F.col(id).cast("double")).approxQuantile(id, quantiles, 0.25 / parts))) if quantiles else []
    tie = F.xxhash64(F.col(text))
    by_hash = F.lit(parts) + F.pmod(tie, F.lit(parts)).cast("int")
    bucket = F.when(F.col(id).isNull(), by_hash).otherwise(_bucket(F.col(id), bounds))
    rows = docs.select(bucket.alias("bucket"), F.col(id).alias("id"), tie.alias("tie"), F.col(text).alias("text"))
    firsts = rows.groupBy("bucket").agg(F.min(F.struct(F.coalesce("id", F.lit(0)).alias("id"), "tie")).alias("first"))
    firsts = sorted((r["bucket"], r["first"]["id"], r["first"]["tie"]) for r in firsts.collect())
    moves = [(*own, firsts[i - 1][0]) for i, own in enumerate(firsts)]
    moves = spark.createDataFrame(moves, "_bucket int, _id bigint, _tie bigint, before int")
    is_first = (F.col("bucket") == F.col("_bucket")) & (F.coalesce("id", F.lit(0)) == F.col("_id")) & (F.col("tie") == F.col("_tie"))
    marked = rows.join(F.broadcast(moves), is_first, "left")
    places = F.array_compact(
        F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("follows")),
            F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("follows"))),
        )
    )
    placed = marked.select(F.explode(places).alias("place"), "id", "tie", "text").select("place.*", "id", "tie", "text")
    return placed.repartition(parts, "bucket").sortWithinPartitions("bucket", "follows", "id", "tie")


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Each document's fingerprint, and that of the document edited with the text of the next one.

    Columns ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The edited text is the text with its last ``floor(n_chars / 2)`` code points replaced by the first
    as many (or all) of the next document, by ascending id, then hash of the text; null ids are last
    and the first document follows the last, so that a single document follows itself. Null texts
    are empty. Each of repeated rows is a document. Other columns are left out.
    """
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def block(ids: list, texts: list[str], follow: list[str]) -> pa.RecordBatch:
        n = len(ids)
        edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, follow, strict=True)]
        own, new, other = (pa.array(x, pa.large_string()) for x in (texts, edited, follow))
        a, b, c = paragraphs(own), paragraphs(new), paragraphs(other)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array(Sketch(n, CELLS).add(*a).texts(), pa.string()),
                pa.array(Sketch(n, CELLS).add(*b).texts(), pa.string()),
                pa.array(likeness(a, b, n)),
                pa.array(likeness(a, c, n)),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, follow, held, size = [], [], [], None, 0
        for batch in batches:
            for bucket, follows, id_, _, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                value = value or ""
                if held is not None and held[0] == bucket:
                    ids.append(held[1])
                    texts.append(held[2])
                    follow.append(value)
                    size += len(held[2]) + len(value)
                # Behind the end of a range only the first of the rows that follow counts.
                held = None if follows else (bucket, id_, value)
                if len(ids) >= 500 or size >= 4_000_000:
                    yield block(ids, texts, follow)
                    ids, texts, follow, size = [], [], [], 0
        if ids:
            yield block(ids, texts, follow)

    return with_next(docs, id, text, parts).mapInArrow(run, schema).withColumnRenamed("id", id)
