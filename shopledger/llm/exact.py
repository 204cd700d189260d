"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are the same after deleting every space and ``\\x09-\\x0D``.

1. One scan gives each row the length of its normalised text and a hash of its first ``PREFIX``
   bytes. Rows are grouped by both; a row that is alone with its length or its prefix is unique.
2. The groups of two or more survive. Their keys become a bit filter of at most ``FILTER_WORDS``
   64-bit words, merged by ``bit_or`` in Spark; only this bounded filter passes the driver.
3. A second scan reads the full content of the rows that pass the filter and takes its SHA-256 in
   the task that reads it: texts are never shuffled. A unique row that passes by chance, or because
   a very large table fills the filter, is hashed too and found alone: the result is the same.
4. Rows with one full hash are equal; which one stays is a minimum for each hash.

Groups of more than a thousandth of all rows (fewer than a thousand groups) meet their rows by a
broadcast, so that no task gets a whole hot group; the others by a shuffle of narrow rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.words import SLICE, SPACE, mix, text_buffers
from shopledger.llm.workspace import Workspace

PREFIX = 256
FILTER_WORDS = 1 << 20
_HOT = 1000
_U = np.uint64
ADDED = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(column: pa.Array) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Some texts at a time: their bytes without white space, the bounds of each, and its code points before."""
    data, offsets = text_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        part = data[offsets[i] : offsets[j]]
        at = offsets[i : j + 1] - offsets[i]
        stays = ~SPACE[part]
        left, chars = (np.concatenate(([0], np.cumsum(x))) for x in (stays, (part & 0xC0) != 0x80))
        yield part[stays].tobytes(), left[at], np.diff(chars[at])
        i = j


def _prefix_hash(raw: bytes, low: int, high: int, prefix: int) -> bytes:
    return hashlib.blake2b(raw[low : min(high, low + prefix)], digest_size=8).digest()


def _bits(length: np.ndarray, prefix: np.ndarray, words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each key two places in a filter of ``words`` 64-bit words: word and bit."""
    h = mix(prefix.view(_U) ^ mix(length.astype(_U)))
    return [(((g >> _U(6)) % _U(words)).astype(np.int64), _U(1) << (g & _U(63))) for g in (h, mix(h + _U(1)))]


def _keys(prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, at, _ in normalised(batch.column(0)):
                at = at.tolist()
                heads = b"".join(_prefix_hash(raw, a, b, prefix) for a, b in zip(at, at[1:], strict=False))
                columns = [pa.array(np.diff(at).astype(np.int64)), pa.array(np.frombuffer(heads, np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["length", "prefix"])

    return run


def _filter(survivors: DataFrame, words: int) -> np.ndarray:
    """The keys of all surviving groups as ``words`` 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, bit in _bits(batch.column(0).to_numpy(), batch.column(1).to_numpy(), words):
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], names=["word", "bits"])

    parts = survivors.select("length", "prefix").mapInArrow(run, "word bigint, bits bigint")
    merged = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most ``words`` rows
    out = np.zeros(words, _U)
    out[merged.column("word").to_numpy()] = merged.column("bits").to_numpy().view(_U)
    return out


def _hashes(prefix: int, wanted: np.ndarray, digests: bool):
    """``_id, _row, length, prefix, n_chars, survives, sha``: the full hash where the key passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for raw, at, chars in normalised(batch.column(2)):
                length, at = np.diff(at).astype(np.int64), at.tolist()
                spans = list(zip(at, at[1:], strict=False))
                heads = np.frombuffer(b"".join(_prefix_hash(raw, a, b, prefix) for a, b in spans), np.int64)
                passes = np.ones(len(spans), bool)
                for word, bit in _bits(length, heads, len(wanted)):
                    passes &= (wanted[word] & bit) != 0
                full = [
                    hashlib.sha256(memoryview(raw)[a:b]).hexdigest() if p or digests else None
                    for (a, b), p in zip(spans, passes.tolist(), strict=True)
                ]
                columns = [batch.column(k).slice(done, len(spans)) for k in (0, 1)]
                columns += [pa.array(chars.astype(np.int64)), pa.array(passes), pa.array(full, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "_row", "n_chars", "survives", "sha"])
                done += len(spans)

    return run


def exact_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    digests: bool = False,
    prefix: int = PREFIX,
    filter_words: int = FILTER_WORDS,
) -> DataFrame:
    """``id``, the columns in ``keep``, and ``keep_id, group_size, kept, text_sha256`` of every row.

    Of equal texts the row with the most code points stays, then that with the least id (null last).
    A null text is empty, and all texts without a visible character are equal. Of rows that agree in
    id and code points too, one stays. ``text_sha256`` is of the normalised text (lowercase hex) and
    null for rows found unique without reading them whole, unless ``digests`` asks for all. Columns
    in ``keep`` that bear the name of a result are replaced by it; other columns are left out. An
    empty table gives an empty table.
    """
    work = Workspace(docs.sparkSession, "exact")
    carried = [c for c in keep or [] if c != id and c not in ADDED]
    rest = F.struct(*[F.col(f"`{c}`") for c in carried]) if carried else F.lit(None).cast("boolean")
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    keys = texts.mapInArrow(_keys(prefix), "length bigint, prefix bigint")
    survivors = work.keep(keys.groupBy("length", "prefix").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "survivors")
    words = min(filter_words, max(1 << 10, 1 << (survivors.count() // 4).bit_length()))
    wanted = _filter(survivors, words)

    rows = docs.select(F.col(f"`{id}`").alias("_id"), rest.alias("_row"), F.col(f"`{text}`").cast("string").alias("text"))
    types = rows.select("_id", "_row").schema
    schema = f"_id {types['_id'].dataType.simpleString()}, _row {types['_row'].dataType.simpleString()}"
    hashed = rows.mapInArrow(_hashes(prefix, wanted, digests), schema + ", n_chars bigint, survives boolean, sha string")
    hashed = work.keep(hashed.withColumn("_nth", F.monotonically_increasing_id()), "hashed")
    work.drop(survivors)

    first = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("_id").isNull().alias("no_id"), "_id", "_nth"))
    groups = hashed.filter("survives").groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first"))
    groups = groups.filter("group_size > 1").select("sha", "group_size", F.col("first._id").alias("keep_id"), F.col("first._nth").alias("_stays"))
    groups = work.keep(groups, "groups")
    limit = hashed.count() // _HOT
    hot, other = F.broadcast(groups.filter(F.col("group_size") > limit)), groups.filter(F.col("group_size") <= limit)
    again = hashed.filter("survives")
    unique = hashed.filter("not survives").withColumns({"group_size": F.lit(None), "keep_id": F.lit(None), "_stays": F.lit(None)})
    found = again.join(hot, "sha").unionByName(again.join(hot, "sha", "left_anti").join(other, "sha", "left")).unionByName(unique)
    alone = F.col("group_size").isNull()
    return found.select(
        F.col("_id").alias(id),
        *[F.col("_row")[c].alias(c) for c in carried],
        F.when(alone, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_stays") == F.col("_nth"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
