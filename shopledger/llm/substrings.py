"""Substring dedup by seed and extend.

*Seed.* Documents are joined on winnowed anchors: of the ``anchor``-word hashes inside a window of
``span`` consecutive words the least is kept (the last of equal ones), so two equal windows keep the
same anchor at the same place, and neighbouring windows mostly share it. Only anchors that occur in
two different documents go on.

*Extend.* Around a shared anchor a match is extended both ways over the whole run of windows that
keep this anchor. Of each run (known by its anchor and a second 64-bit hash of all its words) the
smallest document is found, and what any other document has of it is a repeat. Where one anchor has
several runs, they may still agree in part: the windows of each run's smallest document are compared
one by one. Repeats that overlap are one maximal repeat, at least ``span`` words long.

Nothing is done in pairs of documents: an anchor or window that a third of all documents share costs
one row for each of them, reduced by a minimum in the map tasks, and the join back to these rows has
two plain exchanges, which adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.words import Hasher, Slice, SpanHasher, slices, window_hashes
from shopledger.llm.workspace import Workspace

SPAN = 13
ANCHOR = 5
_WORD = Hasher(51)
_RUN = SpanHasher(61)


def anchors(part: Slice, h: np.ndarray, span: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that lie in one document, and the place of the anchor each keeps."""
    n = len(h) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = window_hashes(h, anchor)
    least, at = grams[:n].copy(), np.arange(n)
    for j in range(1, span - anchor + 1):
        here = grams[j : j + n]
        smaller = here <= least
        least[smaller] = here[smaller]
        at[smaller] = np.flatnonzero(smaller) + j
    inside = np.flatnonzero(part.doc[:n] == part.doc[span - 1 :])
    return inside, at[inside]


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and the end."""
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)])) if len(values) else np.zeros(1, np.int64)


def _anchor_rows(span: int, anchor: int, runs: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``anchor, id`` once for each document; with ``runs``: each run of windows, its words' hash and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1)):
                h = _WORD(part.data, part.starts, part.ends)
                starts, at = anchors(part, h, span, anchor)
                grams = window_hashes(h, anchor)
                borders = _runs(at)
                first, length = starts[borders[:-1]], np.diff(borders)
                doc = part.doc[first]
                key = grams[at[borders[:-1]]].view(np.int64)
                if runs:
                    words = _RUN(h, first, first + length + (span - 1)).view(np.int64)
                    place = [(first - part.first[doc]).astype(np.int32), length.astype(np.int32)]
                    columns = [key, words, ids[part.rows.start + doc], *place]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "words", "id", "begin", "windows"])
                else:
                    order = np.lexsort((key, doc))
                    key, doc = key[order], doc[order]
                    new = np.ones(len(key), bool)
                    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                    yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(ids[part.rows.start + doc[new]])], names=["anchor", "id"])

    return run


def _window_rows(span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``anchor, words, id, at`` for the windows of the given runs of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            flat, offsets = lists.flatten(), lists.offsets.to_numpy()
            keys, begins, counts = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            offsets = offsets - offsets[0]
            for part in slices(batch.column(1)):
                low, high = offsets[part.rows.start], offsets[part.rows.stop]
                count = counts[low:high].astype(np.int64)
                if not count.sum():
                    continue
                doc = np.repeat(np.arange(len(part.rows)), np.diff(offsets[part.rows.start : part.rows.stop + 1]))
                start = part.first[doc] + begins[low:high]
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                at = np.repeat(start, count) + nth
                doc = np.repeat(doc, count)
                words = window_hashes(_WORD(part.data, part.starts, part.ends), span, 9)[at].view(np.int64)
                columns = [np.repeat(keys[low:high], count), words, ids[part.rows.start + doc], (at - part.first[doc]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "words", "id", "at"])

    return run


def spans_of(places: list[int] | None, span: int) -> list[tuple[int, int]]:
    """Starts of repeated windows as maximal ranges of words."""
    out: list[tuple[int, int]] = []
    for at in sorted(places or ()):
        if out and at <= out[-1][1]:
            out[-1] = (out[-1][0], at + span)
        else:
            out.append((at, at + span))
    return out


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", span: int = SPAN, anchor: int = ANCHOR) -> DataFrame:
    """``id, places``: the starts of all windows of a document that a document with a smaller id holds.

    Windows are judged on the given texts. Null ids have no order and take no part; rows with one id
    are one document in this respect. Documents without a repeat have no row.
    """
    if not 1 <= anchor <= span:
        raise ValueError("an anchor must fit into the span")
    spark = docs.sparkSession
    work = Workspace(spark, "substrings")
    texts = docs.filter(F.col(id).isNotNull() & F.col(text).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    seeds = texts.mapInArrow(_anchor_rows(span, anchor, False), "anchor bigint, id bigint")
    seeds = seeds.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = work.keep(seeds.filter("low < high").select("anchor"), "anchors")

    runs = texts.mapInArrow(_anchor_rows(span, anchor, True), "anchor bigint, words bigint, id bigint, begin int, windows int")
    runs = work.keep(runs.join(shared, "anchor", "left_semi"), "runs")
    work.drop(shared)
    first = work.keep(runs.groupBy("anchor", "words").agg(F.min("id").alias("low")), "first-runs")
    several = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    several = work.keep(first.join(several, "anchor", "left_semi"), "several")
    again = runs.join(first, ["anchor", "words"]).filter("low < id")
    again = work.keep(again.select("id", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("windows") - 1)).alias("at")), "again")

    # Runs that agree in part: of each the smallest document, window by window.
    part = runs.join(several, ["anchor", "words"]).filter("low = id").groupBy("id")
    part = work.keep(part.agg(F.collect_list(F.struct("anchor", "begin", "windows")).alias("runs")), "part")
    for table in (runs, first, several):
        work.drop(table)
    windows = texts.join(part, "id").select("id", "text", "runs")
    windows = work.keep(windows.mapInArrow(_window_rows(span), "anchor bigint, words bigint, id bigint, at int"), "windows")
    first = windows.groupBy("anchor", "words").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    first = work.keep(first.filter("low < high").drop("high"), "first-windows")
    later = windows.join(first, ["anchor", "words"]).filter("low < id").select("id", "at")
    out = later.unionByName(again).groupBy("id").agg(F.collect_set("at").alias("places"))
    out = work.keep(out, "places")
    for table in (part, windows, first, again):
        work.drop(table)
    return out


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    span: int = SPAN,
    anchor: int = ANCHOR,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` without the words of repeated windows, with ``n_words, n_removed, spans, kept_sha256``.

    ``text`` becomes the kept words joined by one space where something was removed and stays as it is
    elsewhere; a null text stays null. ``spans`` are the maximal repeats (``from`` and ``to`` in words,
    ``to`` excluded). ``kept_sha256`` is of the kept words joined by one space. Columns of these names
    are replaced, other columns (or those in ``keep``) pass.
    """
    added = ["n_words", "n_removed", "spans", "kept_sha256"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    found = repeats(docs, id, text, span, anchor).withColumnsRenamed({"id": "_repeat_id", "places": "_repeat_places"})
    rows = docs.select(*keep, F.col(id).cast("long").alias("_doc"), F.col(text).alias("_whole"))
    rows = rows.join(found, F.col("_doc") == F.col("_repeat_id"), "left").select(*keep, "_whole", "_repeat_places")
    types = {c: docs.schema[c].dataType.simpleString() for c in keep}
    schema = ", ".join([f"`{c}` {t}" for c, t in types.items()])
    schema += ", n_words bigint, n_removed bigint, spans array<struct<from:int,to:int>>, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                places = part.column(len(keep) + 1).to_pylist()
                whole = part.column(len(keep))
                given = whole.to_pylist() if text in keep else None
                n_words, n_removed, spans, hashes, texts = [], [], [], [], []
                for own in slices(whole):
                    raw = own.data.tobytes()
                    for i, row in enumerate(own.rows):
                        first, last = int(own.first[i]), int(own.first[i + 1])
                        cut = spans_of(places[row], span)
                        left = np.ones(last - first, bool)
                        for a, b in cut:
                            left[a:b] = False
                        kept = np.flatnonzero(left) + first
                        words = [raw[s:e] for s, e in zip(own.starts[kept].tolist(), own.ends[kept].tolist(), strict=True)]
                        joined = b" ".join(words)
                        n_words.append(last - first)
                        n_removed.append(last - first - len(words))
                        spans.append([{"from": a, "to": b} for a, b in cut])
                        hashes.append(hashlib.sha256(joined).hexdigest())
                        if given is not None:
                            texts.append(joined.decode() if cut else given[row])
                columns = list(part.columns[: len(keep)])
                if given is not None:
                    columns[keep.index(text)] = pa.array(texts, part.schema.field(keep.index(text)).type)
                kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
                columns += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, kind), pa.array(hashes, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *added])

    return rows.mapInArrow(run, schema)
