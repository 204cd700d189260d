"""Near-duplicates by bottom-k sketches of one hash function.

A document is the set of its distinct ``words``-word shingles, each a 64-bit hash; its sketch is the
``k`` least of them. Rows with equal sets are one *node* from the start. Then:

1. *Inverted lists.* Two sets with a Jaccard index of at least 3/4 share at least ``_least_common``
   retained values, for certain where the sketches are the whole sets and else but for about one
   in a million of the pairs that lie on the limit. So it is enough to list a node under its rarest
   retained values, as many as leave fewer than that out: passages that many documents share fill no
   lists unless they are about half of a document. Lists hold ids only.
2. *Few against all.* In each list every node is compared with the least and the greatest one, and
   those that are not joined yet with some of the list's largest component. That is linear in the
   list and joins near copies, however many.
3. *Union sketch.* The ``k`` least values of both sketches are a sketch of the union, and the share
   of them that both retain estimates the Jaccard index: pairs far below go.
4. *Exact.* The rest is decided on full sets: ``100 * common >= 75 * union``.
5. *What is still apart.* Nodes outside of a list's largest component are compared with all nodes of
   the list, in blocks inside tasks, by sketches and then on full sets. Only links between different
   components leave a task, fewer than it has components, so the output is linear. Lists that have
   their largest component in common are looked at together where that means fewer pairs.

Components of the links give the groups. Lists, sets and links stay in Spark; texts of documents in
no list are not looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.llm.components import components
from shopledger.llm.words import Hasher, mix, shingle_sets, slices
from shopledger.llm.workspace import Workspace

K = 128
WORDS = 5
PERCENT = 75
PIVOTS = 8
#: Values in a block of sets that meets another one: 8 MB.
BLOCK = 1 << 20
_WORD = Hasher(71, fold=True)
_TOP, _OTHER = np.uint64(1 << 63), np.uint64(0x9FB21C651E98DF25)


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Of each text its sorted shingle set, as signed numbers."""
    for part in slices(column):
        for s in shingle_sets(part, _WORD(part.data, part.starts, part.ends), words):
            yield (s ^ _TOP).view(np.int64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))


def _set_hashes(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    u = s.view(np.uint64)
    return np.add.reduce(mix(u), dtype=np.uint64), np.add.reduce(mix(u ^ _OTHER), dtype=np.uint64)


def _longs(hashes: list[np.uint64]) -> pa.Array:
    return pa.array(np.array(hashes, dtype=np.uint64).view(np.int64))


def sketches(docs: DataFrame, id: str, text: str, k: int, words: int) -> DataFrame:
    """``id, mark, n, ha, hb, sketch``: hash of the text, set size, a 128-bit hash of the set, its ``k`` least values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ha, hb, least = [], [], [], []
            for s in _sets(batch.column(2), words):
                n.append(len(s))
                for hashes, h in zip((ha, hb), _set_hashes(s), strict=True):
                    hashes.append(h)
                least.append(s[:k])
            columns = [*batch.columns[:2], pa.array(n, pa.int64()), _longs(ha), _longs(hb), _lists(least)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "n", "ha", "hb", "sketch"])

    rows = docs.select(F.col(id).cast("long").alias("id"), text_mark(text).alias("mark"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, mark bigint, n bigint, ha bigint, hb bigint, sketch array<bigint>")


def text_mark(text: str) -> Column:
    """Tells the texts of rows with one id apart."""
    return F.xxhash64(text)


def full_sets(docs: DataFrame, id: str, text: str, wanted: DataFrame, words: int) -> DataFrame:
    """``ha, hb, shingles`` of the rows whose id is in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                sets = list(_sets(batch.column(0).slice(low, 1000), words))
                ha, hb = zip(*map(_set_hashes, sets), strict=True)
                yield pa.RecordBatch.from_arrays([_longs(list(ha)), _longs(list(hb)), _lists(sets)], names=["ha", "hb", "shingles"])

    ids = wanted.select(F.col("id").alias("_wanted"))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.join(ids, F.col("id").eqNullSafe(F.col("_wanted")), "left_semi").select("text")
    return rows.mapInArrow(run, "ha bigint, hb bigint, shingles array<bigint>")


def _least_common(n: Column, k: int, percent: int) -> Column:
    """How many retained values a set of ``n`` shares at least with any set that it is linked with.

    With small sets both are whole in their sketches, and the bound is exact. Else at least
    ``percent`` of the ``k`` least values of the union (which has ``n / percent`` elements at most)
    are common in the mean, as drawn without replacement; five standard deviations are left for chance.
    """
    share = percent / 100
    union = F.greatest(n / share, F.lit(k))
    deviation = F.sqrt(k * share * (1 - share) * (union - k) / (union - 1))
    return F.least(F.ceil(n * percent / 100), F.greatest(F.floor(k * share - 5 * deviation), F.lit(1))).cast("int")


def inverted_lists(sketched: DataFrame, k: int, percent: int) -> DataFrame:
    """``value, id, n``: each document under its rarest retained values that others retain too.

    The rows of one value are counted in one task, and spill there: they are ids, one for a document
    at most, of the up to ``k`` that each document has.
    """
    values = sketched.select("id", "n", F.explode("sketch").alias("value"))
    often = values.withColumn("often", F.count(F.lit(1)).over(W.partitionBy("value"))).filter("often > 1")
    shared = often.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("shared"))
    retained = F.least(F.col("n"), F.lit(k)).cast("int")
    alone = retained - F.size("shared")  # the rarest of all: nobody else retains them
    take = retained - _least_common(F.col("n"), k, percent) + 1 - alone
    listed = shared.withColumn("_take", take).filter("_take > 0")
    return listed.select("id", "n", F.explode(F.slice("shared", F.lit(1), F.col("_take"))["value"]).alias("value"))


def _estimate_passes(k: int, percent: int) -> Column:
    """Whether the union sketch allows a link (columns ``na, nb, sa, sb``)."""
    union = F.array_sort(F.array_union("sa", "sb"))
    whole = (F.col("na") <= k) & (F.col("nb") <= k)
    least = F.when(whole, union).otherwise(F.slice(union, 1, k))
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), least))
    enough = common * 100 >= percent * F.size(least)
    return F.when(whole, enough).otherwise(common >= _least_common(F.greatest("na", "nb"), k, percent))


def verified(pairs: DataFrame, sketched: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are linked: by the union sketch first, then on full sets."""
    left = sketched.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketched.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    near = pairs.join(left, "a").join(right, "b").filter(_estimate_passes(k, percent)).select("a", "b", "na", "nb")
    near = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    near = near.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return near.filter(common * 100 >= percent * (F.col("na") + F.col("nb") - common)).select("a", "b")


def open_lists(work: Workspace, lists: DataFrame, groups: DataFrame) -> DataFrame:
    """``value, id, n, component, main`` of the lists that hold several components; ``main`` is the largest."""
    labelled = lists.join(groups, "id", "left").select("value", "id", "n", F.coalesce("component", "id").alias("component"))
    labelled = work.keep(labelled, "labelled")
    parts = labelled.groupBy("value", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("value").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("parts"))
    main = work.keep(main.filter("parts > 1").select("value", "main"), "main")
    return labelled.join(main, "value")


def _least_common_of(n: np.ndarray, k: int, percent: int) -> np.ndarray:
    """``_least_common`` of numbers."""
    share = percent / 100
    union = np.maximum(n / share, k)
    deviation = np.sqrt(k * share * (1 - share) * (union - k) / (union - 1))
    return np.minimum(-(-n * percent // 100), np.maximum(np.floor(k * share - 5 * deviation), 1)).astype(np.int64)


class _Overlaps:
    """How many values a set has in common with each of many sets, of which the first ``most`` values count."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray, most: int | None = None):
        sizes = np.diff(offsets) if most is None else np.minimum(np.diff(offsets), most)
        self.starts = np.cumsum(sizes) - sizes
        at = np.repeat(offsets[:-1] - self.starts, sizes) + np.arange(int(sizes.sum()))
        self.known, self.places = np.unique(values[at], return_inverse=True)
        self.has = np.zeros(len(self.known), np.int64)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, values), len(self.known) - 1)
        at = at[self.known[at] == values]
        self.has[at] = 1
        out = np.add.reduceat(self.has[self.places], self.starts)
        self.has[at] = 0
        return out


def spanning_links(left: np.ndarray, node: np.ndarray, component: np.ndarray, sets: pa.ListArray, k: int, percent: int) -> list[tuple[int, int]]:
    """Links between the rows marked ``left`` and the others, as many as join different components."""
    offsets, values = sets.offsets.to_numpy(), sets.values.to_numpy()
    offsets = offsets.astype(np.int64)
    n = np.diff(offsets)
    right = np.flatnonzero(~left)
    if not len(right):
        return []
    bounds = offsets[[right[0], *(right + 1)]]  # the right rows come together, behind the left ones
    sketched, whole = _Overlaps(values, bounds, k), None
    size, label = n[right], component[right].copy()
    least, found = _least_common_of(size, k, percent), []
    joined = {}
    for u in np.flatnonzero(left):
        own = component[u]
        while own in joined:
            own = joined[own]
        near = (np.minimum(size, n[u]) * 100 >= np.maximum(size, n[u]) * percent) & (label != own)
        if not near.any():
            continue
        values_u = values[offsets[u] : offsets[u + 1]]
        near &= sketched(values_u[:k]) >= np.maximum(least, _least_common_of(n[u : u + 1], k, percent)[0])
        if not near.any():
            continue
        whole = whole or _Overlaps(values, bounds)
        common = whole(values_u)
        near &= common * 100 >= percent * (size + n[u] - common)
        while near.any():
            v = int(np.argmax(near))
            found.append((int(node[u]), int(node[right[v]])))
            joined[own] = label[v]
            label[label == own] = label[v]
            own = label[v]
            near &= label != own
    return found


def _compared(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def links() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            right, node, component = (table.column(c).to_numpy() for c in ("side", "id", "component"))
            sets = table.column("shingles").combine_chunks()
            sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
            found = np.array(spanning_links(right == 0, node, component, sets, k, percent), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(found.min(1)), pa.array(found.max(1))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            new = [0, *(np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1).tolist(), len(keys)]
            for low, high in zip(new, new[1:], strict=False):
                if held and tuple(keys[low]) != last:
                    yield links()
                    held = []
                held.append(batch.slice(low, high - low))
                last = tuple(keys[low])
        if held:
            yield links()

    return run


def links_apart(work: Workspace, left: DataFrame, sets: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    """``a, b``: links between different components of the open lists ``left``, enough to join what is linked.

    A unit of work is a block of nodes outside of the main component against a block of all nodes,
    each of about ``block`` values. The lists of one main component are one group if that has fewer pairs.
    """
    outside = F.col("component") != F.col("main")
    by_list = left.groupBy("value", "main").agg(F.count(F.lit(1)).alias("c"), F.count_if(outside).alias("o"))
    by_list = by_list.groupBy("main").agg(F.sum(F.col("c") * F.col("o")).alias("pairs"))
    by_main = left.select("main", "component", "id").distinct().groupBy("main").agg(F.count(F.lit(1)).alias("c"), F.count_if(outside).alias("o"))
    together = by_main.join(by_list, "main").select("main", (F.col("c") * F.col("o") <= F.col("pairs")).alias("together"))
    rows = left.join(together, "main").select("together", F.when(F.col("together"), F.col("main")).otherwise(F.col("value")).alias("grp"), "main", "component", "id", "n")
    rows = work.keep(rows.distinct(), "apart")
    parts = rows.groupBy("together", "grp").agg(
        F.ceil(F.sum(F.when(outside, F.col("n"))) / block).alias("lefts"), F.ceil(F.sum("n") / block).alias("rights")
    )
    rows = rows.join(parts, ["together", "grp"])
    every_left, every_right = (F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)) for c in ("lefts", "rights"))
    common = ["together", "grp"]
    as_left = rows.filter(outside).select(*common, F.pmod(F.xxhash64("id"), "lefts").alias("i"), every_right.alias("j"), F.lit(0).alias("side"), "id", "component")
    as_right = rows.select(*common, every_left.alias("i"), F.pmod(F.xxhash64("id"), "rights").alias("j"), F.lit(1).alias("side"), "id", "component")
    units = as_left.unionByName(as_right).join(sets, "id").select(*common, "i", "j", "side", "id", "component", "shingles")
    unit = ["together", "grp", "i", "j"]
    ordered = units.repartition(*unit).sortWithinPartitions(*unit, "side", "id")
    return work.keep(ordered.mapInArrow(_compared(k, percent), "a bigint, b bigint").distinct(), "rest")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """``id, n_shingles, component_id, kept, mark, stays`` of every row.

    Words are runs other than space and ``\\x09-\\x0D``, A-Z lower-cased. A text with fewer than
    ``words`` words is one shingle; a null text or one without words has an empty set and is linked
    with nothing. ``component_id`` is the least id of the group, ``kept`` says whether it is the own
    one. Every row counts with its own text: an id that occurs with several texts is in the group of
    each (``mark`` is the text's hash), and rows without an id take part; a group of such rows alone
    has no ``component_id``, and its rows are kept. ``stays`` marks exactly one row of each group: that
    with the least id, null last. Other columns are left out; ids must be whole numbers. An empty
    table gives an empty table.
    """
    work = Workspace(docs.sparkSession, "neardup")
    every = work.keep(sketches(docs, id, text, k, words).withColumn("row", F.monotonically_increasing_id()), "sketches")
    own = ["n", "ha", "hb"]
    some = every.filter("n > 0")
    equal = work.keep(some.groupBy(*own).agg(F.min("row").alias("node")), "equal")
    reps = some.join(equal.select(F.col("node").alias("row")), "row", "left_semi")
    reps = work.keep(reps.select(F.col("row").alias("id"), F.col("id").alias("doc"), *own, "sketch"), "reps")
    rows = work.keep(every.drop("sketch").join(equal, own, "left").select("row", "id", "mark", "n", "node"), "rows")
    for table in (every, equal):
        work.drop(table)
    lists = work.keep(inverted_lists(reps, k, percent), "lists")
    listed = work.keep(reps.join(lists.select("id").distinct(), "id", "left_semi"), "listed")
    work.drop(reps)
    sets = full_sets(docs, id, text, listed.select(F.col("doc").alias("id")).distinct(), words)
    sets = work.keep(sets.join(listed.select("id", "ha", "hb"), ["ha", "hb"]).select("id", "shingles").dropDuplicates(["id"]), "sets")

    # Each list against its least and its greatest node.
    ends = work.keep(lists.groupBy("value").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high"), "ends")
    to_ends = lists.join(ends, "value").select("id", F.explode(F.array("low", "high")).alias("end"))
    pairs = to_ends.filter("id != end").select(F.least("id", "end").alias("a"), F.greatest("id", "end").alias("b")).distinct()
    links = work.keep(verified(pairs, listed, sets, k, percent), "links")
    groups = components(work, links)

    # Lists with several components left: first against some nodes of the largest component ...
    left = open_lists(work, lists, groups)
    some_of_main = left.filter("component = main").groupBy("value").agg(
        F.array(*[F.min(F.struct(F.xxhash64("id", F.lit(i)), "id"))["id"] for i in range(PIVOTS)]).alias("pivots")
    )
    some_of_main = work.keep(some_of_main, "pivots")
    to_main = left.filter("component != main").join(some_of_main, "value").select("id", F.explode("pivots").alias("pivot"))
    pairs = to_main.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    more = work.keep(verified(pairs, listed, sets, k, percent), "more")
    links = links.unionByName(more)
    groups = components(work, links)
    # ... then what is still apart, block by block.
    rest = links_apart(work, open_lists(work, lists, groups), sets, k, percent, block)
    groups = components(work, links.unionByName(rest))
    for table in (lists, listed, sets, ends, some_of_main, more, rest):
        work.drop(table)

    found = rows.join(groups.withColumnRenamed("id", "node"), "node", "left")
    found = found.withColumn("component", F.coalesce("component", "node"))
    # Without words a row is a group of its own; the others share the least id of theirs.
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    least = found.filter("component is not null").groupBy("component").agg(best.alias("best"))
    out = found.join(least, "component", "left")
    alone = F.col("component").isNull()
    component_id = F.when(alone, F.col("id")).otherwise(F.col("best.id"))
    return out.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        component_id.alias("component_id"),
        component_id.eqNullSafe(F.col("id")).alias("kept"),
        "mark",
        (alone | (F.col("best.row") == F.col("row"))).alias("stays"),
    )
