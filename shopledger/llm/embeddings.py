"""Embedding near-dedup by sorted passes over random hashes.

Equal vectors are one from the start. In each pass every vector gets a key, the concatenation of
random hashes: it is taken relative to a centre, rotated at random, and each hash is the axis it is
then closest to (with its sign). Spark sorts the table by these keys in lexicographic order, and each
vector is compared with at least the next ``window`` ones; those with a cosine of at least ``cosine``
are links. Passes differ in their rotations, and their number grows with the rows; components of the
links of all passes are the groups.

Centres follow the data, so that a hot topic or a common direction of all vectors is spread like any
other data: a tree is fitted on a bounded sample (``fit_rows`` vectors drawn by a hash of the id), in
which the members of a range are centred on their mean and hashed, again and again while the whole
table is expected to put more than ``window`` vectors into the range and the sample still has
``FIT_LEAST`` of them. ``TAIL`` further hashes order what a range of the tree holds, and vectors that
still agree are ordered by a hash of their id and the pass. The sample only shapes keys: all vectors
are sorted and compared, and what fits one window is compared whole.

A window bounds what a pass compares, not what is counted: the number of links of a vector is taken
among all members of its component, in blocks of pairs of at most about ``block`` vectors, so that
large groups of close vectors lose none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.components import components
from shopledger.llm.words import mix
from shopledger.llm.workspace import Workspace

COSINE = 0.95
PASSES = 16
PASSES_UP_TO = 20_000  # vectors; beyond, passes grow with the power GROWTH of their number
GROWTH = 0.35
WINDOW = 1024
AXES = 64
FIT_ROWS = 16_384
FIT_VALUES = 1 << 22  # numbers in the sample: fewer vectors if they are long
FIT_LEAST = 48
DEPTH = 16  # hashes of the tree at most
TAIL, TAIL_AXES = 12, 4
STRIPE = 4  # windows in one task's group
TOGETHER = 8  # passes at once, fewer from 6 million vectors on
_TURN = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=256)
def _rotation(dimension: int, turn: int, depth: int, axes: int) -> np.ndarray:
    return np.random.default_rng((dimension, turn, depth, axes)).standard_normal((dimension, axes))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def passes_for(rows: int, passes: int = PASSES) -> int:
    return math.ceil(passes * max(1.0, rows / PASSES_UP_TO) ** GROWTH)


@dataclass
class Centre:
    """The mean of a range, the axes of its hash (0: not hashed), the ranges of its cells."""

    mean: np.ndarray
    axes: int = 0
    inside: dict[int, Centre] = field(default_factory=dict)


def _cells(x: np.ndarray, at: Centre, turn: int, depth: int) -> np.ndarray:
    along = (x - at.mean) @ _rotation(x.shape[1], turn, depth, at.axes)
    best = np.abs(along).argmax(axis=1)
    return 2 * best + (along[np.arange(len(best)), best] > 0)


def fit(sample: np.ndarray, scale: float, turn: int, window: int, depth: int = 0) -> Centre:
    """The tree of a pass; each vector of ``sample`` stands for ``scale`` vectors of the table."""
    at = Centre(sample.mean(axis=0))
    if len(sample) < FIT_LEAST or len(sample) * scale <= window or depth == DEPTH:
        return at
    at.axes = min(max(math.ceil(len(sample) * scale / window), 2), AXES)
    cell = _cells(sample, at, turn, depth)
    for c in np.unique(cell).tolist():
        # The mean of a few says little: their range keeps the centre above.
        own = sample[cell == c]
        at.inside[c] = fit(own, scale, turn, window, depth + 1) if len(own) >= FIT_LEAST // 2 else Centre(at.mean)
    return at


def sort_keys(x: np.ndarray, ids: np.ndarray, tree: Centre | None, turn: int) -> np.ndarray:
    """A row of bytes for each vector: the hashes of the tree, those of the tail, a tie-break."""
    out = np.zeros((len(x), DEPTH + TAIL), np.uint8)
    moved = x.copy()
    todo = [(np.arange(len(x)), tree, 0)] if tree is not None else []
    while todo:
        rows, at, depth = todo.pop()
        if not at.axes:
            moved[rows] -= at.mean
            continue
        cell = _cells(x[rows], at, turn, depth)
        out[rows, depth] = cell + 1
        order = np.argsort(cell, kind="stable")
        borders = np.flatnonzero(np.diff(cell[order])) + 1
        for part in np.split(order, borders):
            todo.append((rows[part], at.inside.get(int(cell[part[0]])) or Centre(at.mean), depth + 1))
    along = moved @ _rotation(x.shape[1], turn, DEPTH, TAIL * TAIL_AXES)
    along = along.reshape(len(x), TAIL, TAIL_AXES)
    best = np.abs(along).argmax(axis=2)
    out[:, DEPTH:] = 2 * best + (np.take_along_axis(along, best[:, :, None], 2)[:, :, 0] > 0)
    out[np.einsum("ij,ij->i", moved, moved) < 1e-20, DEPTH:] = 0
    ties = mix(ids.astype(np.uint64) ^ mix(np.full(len(ids), turn + 1, np.uint64) * _TURN))
    return np.hstack([out, ties.astype(">u8").view(np.uint8).reshape(-1, 8)])


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dimension)


def _keyed(trees: list[dict[int, Centre]], low: int):
    """Rows ``turn, dimension, key, id`` of the passes from ``low`` on, one tree for each dimension in the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for dimension in np.unique(sizes).tolist():
                rows = batch.take(pa.array(np.flatnonzero(sizes == dimension)))
                for start in range(0, rows.num_rows, 16_384):
                    part = rows.slice(start, 16_384)
                    x, ids = unit(_matrix(part.column(1), dimension)), part.column(0).to_numpy()
                    for t, own in enumerate(trees):
                        keys = sort_keys(x, ids, own.get(dimension), low + t)
                        keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(keys.shape[1]), len(keys), [None, pa.py_buffer(keys.tobytes())])
                        heads = [pa.array(np.full(len(x), v, np.int32)) for v in (low + t, dimension)]
                        yield pa.RecordBatch.from_arrays([*heads, keys.cast(pa.binary()), part.column(0)], names=["turn", "dimension", "key", "id"])

    return run


def _spanning(close: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs that connect what the symmetric ``close`` connects."""
    seen = np.zeros(len(close), bool)
    for start in np.flatnonzero(close.any(axis=1)).tolist():
        if seen[start]:
            continue
        reached = np.zeros(len(close), bool)
        front = np.array([start])
        reached[start] = True
        while len(front):
            front = np.flatnonzero(close[front].any(axis=0) & ~reached)
            reached[front] = True
        seen |= reached
        reached[start] = False
        for other in np.flatnonzero(reached).tolist():
            yield start, other


def _grouped(batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``work`` of each run of rows that agree in the first three columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        c, i, j = (batch.column(k).to_numpy() for k in range(3))
        borders = np.flatnonzero((np.diff(c) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        borders = [0, *borders.tolist(), batch.num_rows]
        for low, high in zip(borders[:-1], borders[1:], strict=True):
            if low == high:
                continue
            own = (c[low], i[low], j[low])
            if held and own != last:
                yield work(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(low, high - low))
            last = own
    if held:
        yield work(pa.Table.from_batches(held))


def _compared(cosine: float, window: int):
    """Links of neighbours in the order of one pass, rows sorted by place; enough to connect the same."""

    def links(group: pa.Table) -> pa.RecordBatch:
        ids, places = group.column("id").to_numpy(), group.column("place").to_numpy()
        x = unit(_matrix(group.column("vector").combine_chunks(), group.column("dimension")[0].as_py()))
        until = (group.column("stripe")[0].as_py() + 1) * STRIPE * window  # what follows starts in the next stripe
        out = []
        for low in range(0, int((places < until).sum()), window):
            around = slice(low, low + 2 * window)
            own = x[low : low + window]
            near = own @ x[around].T >= cosine
            near[np.arange(len(own)), np.arange(len(own))] = False
            # Only vectors with a link are looked at further.
            linked = near.any(axis=0)
            linked[: len(own)] |= near.any(axis=1)
            some = np.flatnonzero(linked)
            if len(some):
                close = np.zeros((len(some),) * 2, bool)
                mine = some[some < len(own)]
                close[: len(mine)] = near[np.ix_(mine, some)]
                close |= close.T
                out += [(ids[low + some[a]], ids[low + some[b]]) for a, b in _spanning(close)]
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return lambda batches: _grouped(batches, links)


def _counted(cosine: float):
    """Links within each pair of blocks, rows sorted by (component, i, j)."""

    def links(group: pa.Table) -> pa.RecordBatch:
        ids, i, j, own = (group.column(c).to_numpy() for c in ("id", "i", "j", "own"))
        copies, sizes = group.column("copies").to_numpy(), group.column("dimension").to_numpy()
        n = np.zeros(len(ids), np.int64)
        vectors = group.column("vector").combine_chunks()
        for dimension in np.unique(sizes):
            rows = np.flatnonzero(sizes == dimension)
            x = unit(_matrix(vectors.take(pa.array(rows)), int(dimension)))
            close = x @ x.T >= cosine
            np.fill_diagonal(close, False)
            if i[0] != j[0]:
                close &= own[rows][:, None] != own[rows][None, :]
            n[rows] = close @ copies[rows]
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "links"])

    return lambda batches: _grouped(batches, links)


def _sample(classes: DataFrame, fit_rows: int) -> tuple[int, float, dict[int, np.ndarray]]:
    """The number of vectors, how many one of the sample stands for, the sample by dimension."""
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("longest")).first()
    rows = max(1, min(fit_rows, FIT_VALUES // (size["longest"] or 1)))
    share = min(1.0, rows / max(size["n"], 1))
    drawn = classes.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(share * (1 << 40))).select("vector").toArrow()
    vectors = drawn.column("vector").combine_chunks()
    sizes = pc.list_value_length(vectors).to_numpy()
    found = {d: unit(_matrix(vectors.take(pa.array(np.flatnonzero(sizes == d))), d)) for d in np.unique(sizes).tolist()}
    return size["n"], 1 / share, found


def _links(work: Workspace, classes: DataFrame, cosine: float, passes: int, window: int, fit_rows: int) -> list[DataFrame]:
    """Tables ``a, b`` of the links that the passes find between the rows ``id, vector``."""
    n, scale, sample = _sample(classes, fit_rows)
    passes = passes_for(n, passes)
    together = max(1, min(TOGETHER, 50_000_000 // max(n, 1)))
    order = ["turn", "dimension", "key", "id"]
    row = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    width = STRIPE * window
    found = []
    for low in range(0, passes, together):
        turns = range(low, min(low + together, passes))
        trees = [{d: fit(x, scale, t, window) for d, x in sample.items()} for t in turns]
        keyed = classes.mapInArrow(_keyed(trees, low), "turn int, dimension int, key binary, id bigint")
        by_key = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        # The upper bits of ``at`` are the range of keys, the lower ones the row in it.
        by_key = work.keep(by_key.select("turn", "dimension", "id", F.monotonically_increasing_id().alias("at")), "order")
        ranges = by_key.groupBy(F.shiftright("at", 33).alias("range")).agg(F.count(F.lit(1)).alias("n"))
        # One row for each task of the sort.
        before = F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1))
        ranges = ranges.select("range", F.coalesce(before, F.lit(0)).alias("before"))
        placed = by_key.withColumn("range", F.shiftright("at", 33)).join(ranges, "range")
        placed = placed.select("turn", "dimension", "id", (F.col("before") + row).alias("place"))
        stripe = F.floor(F.col("place") / width)
        ends = F.when((F.col("place") % width < window) & (F.col("place") >= width), F.array(stripe, stripe - 1)).otherwise(F.array(stripe))
        near = placed.select(F.explode(ends).alias("stripe"), "turn", "dimension", "place", "id").join(classes, "id")
        near = near.select("stripe", "turn", "dimension", "place", "id", "vector")
        near = near.repartition("stripe").sortWithinPartitions("stripe", "place")
        found.append(work.keep(near.mapInArrow(_compared(cosine, window), "a bigint, b bigint"), "links"))
        work.drop(by_key)
    return found


def near_vectors(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    passes: int = PASSES,
    window: int = WINDOW,
    block: int = 512,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row.

    Null, empty and zero vectors and those with a null or non-finite component link with nothing, and
    so do vectors of different lengths and rows with a null id (``component_id`` null, kept). Equal
    vectors are links of each other. Rows with one id have one component. Other columns are left out.
    """
    work = Workspace(vectors.sparkSession, "embeddings")
    usable = "id is not null and size(vector) > 0 and exists(vector, x -> x != 0)"
    usable += " and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    # Floats stay floats where they are stored; all is computed with doubles.
    given = vectors.select(vector).schema[0].dataType
    kind = "float" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "double"
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
    classes = rows.filter(usable).groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = work.keep(classes, "classes")
    found = _links(work, classes.select("id", "vector"), cosine, passes, window, fit_rows)
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    members = rows.filter(usable).join(classes.select("vector", F.col("id").alias("rep")), "vector").select("id", "rep")
    members = work.keep(members, "members")
    groups = components(work, links)

    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sized = groups.join(sizes, "component").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    sized = sized.select("id", "component", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    near = sized.join(classes, "id").select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "own", "copies",
        F.size("vector").alias("dimension"), "vector",
    )
    near = near.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "id")
    counted = near.mapInArrow(_counted(cosine), "id bigint, links bigint").groupBy("id").agg(F.sum("links").alias("links"))
    counted = classes.join(counted, "id", "left").select(
        F.col("id").alias("rep"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    # Ids of one class may be further joined through an id that has several vectors.
    both = links.unionByName(members.filter("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    final = components(work, both)
    per_id = members.join(counted, "rep").groupBy("id").agg(F.max("n_links").alias("n_links"))
    per_id = work.keep(per_id, "counts")
    out = rows.select("id").join(per_id, "id", "left").join(final, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
