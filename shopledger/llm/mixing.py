"""Mixing sources to target weights by pivotal dependent rounding, on DataFrame functions only.

A source with the target ``T`` and the total size ``S`` takes each of its documents ``T / S`` times:
the whole part for certain, and the fractional part ``p`` by dependent rounding. Two documents with
fractional shares meet; mass, counted in words, moves from one to the other until one share is 0 or
1, in a direction drawn so that both keep their expectation. What stays fractional meets the next
one. So the words of a source are kept exactly until a single document is left, and that one is
rounded by a draw of its own.

Work is a tree: documents of a source fall into blocks of about ``block`` by a hash, each block is
folded by itself, and its one fractional document goes to the next level, where again ``block`` of
them make a group. A source with a third of all rows has as many blocks as its rows need. In a
block the largest documents come first, so the left-over is a small one. Draws are hashes of the
two documents that meet; a rerun takes the same documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.llm.workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` of each source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all sizes. A
    target stops at ``most`` times its source's size, the excess is shared by weight again until
    none is above: with the sources in order of the level at which they fill up, the level rises
    while full ones are taken out and falls after; the final one is the highest that the rest holds. One row per source enters the windows, not one per document.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    weighted = totals.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    weighted = weighted.withColumn("_cap", most * F.col("source_size"))
    weighted = weighted.withColumn("_full_at", F.col("_cap") / F.col("_weight"))
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.orderBy("_full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    leveled = weighted.withColumn("_level", left / weight_left)
    final = F.max(F.when(F.col("_level") <= F.col("_full_at"), F.col("_level"))).over(everything)
    return leveled.withColumn(
        "target", F.least("_cap", F.coalesce(final * F.col("_weight"), F.col("_cap"))).cast("double")
    ).select("source", "source_size", "target")


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / float(1 << 53)


def _meet(state: Column, unit: Column, seed: int) -> Column:
    """Two fractional units meet: one becomes whole and is noted, the other is carried on."""
    carried = state["carried"]
    wa, wb, pa, pb = carried["size"].cast("double"), unit["size"].cast("double"), carried["p"], unit["p"]
    up = F.least((1 - pa) * wa, pb * wb)  # words that may move to the carried one
    down = F.least(pa * wa, (1 - pb) * wb)
    to_carried = _uniform(carried["key"], unit["key"], F.lit(seed)) * (up + down) < down
    moved = F.when(to_carried, up).otherwise(-down)

    def snapped(p: Column) -> Column:
        return F.when(p < _EPS, F.lit(0.0)).when(p > 1 - _EPS, F.lit(1.0)).otherwise(p)

    a = F.struct(carried["size"].alias("size"), carried["key"].alias("key"), snapped(pa + moved / wa).alias("p"))
    b = F.struct(unit["size"].alias("size"), unit["key"].alias("key"), snapped(pb - moved / wb).alias("p"))
    # Rounding errors may leave neither at a whole number: the nearer one is then taken as whole.
    a_whole = F.abs(a["p"] - F.round(a["p"])) <= F.abs(b["p"] - F.round(b["p"]))
    done, rest = F.when(a_whole, a).otherwise(b), F.when(a_whole, b).otherwise(a)
    done = F.struct(done["key"].alias("key"), F.round(done["p"]).cast("int").alias("extra"))
    return F.struct(rest.alias("carried"), F.concat(state["done"], F.array(done)).alias("done"))


def _fold(units: Column, seed: int) -> Column:
    """All units of one block, largest first."""
    none = F.expr("cast(array() as array<struct<key:bigint,extra:int>>)")
    start = F.struct(F.element_at(units, 1).alias("carried"), none.alias("done"))
    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), start, lambda s, u: _meet(s, u, seed))


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id: str = "doc_id",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block: int = 128,
    seed: int = 17,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies`` and ``taken``.

    ``size`` is the number of words (null text: 0), ``taken`` = ``size * copies``. A document without
    words takes no part in the rounding and has ``floor(target / source_size)`` copies; in a source
    without any word the target is 0 and no document has a copy. Rows that agree in id, source and
    text are rounded together and have equally many copies. A null source is a source, a null id an
    id. Columns of ``docs`` that are named like results are replaced. An empty table gives an empty
    result.
    """
    work = Workspace(docs.sparkSession, "mixing")
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "copies")]
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.xxhash64(F.col(id), F.col(source), F.col(text))
    sizes = work.keep(docs.select(F.col(source).alias("source"), size.alias("size"), key.alias("key")), "sizes")
    targets = work.keep(source_targets(sizes, weights, share, most), "targets")

    units = sizes.filter("size > 0").groupBy("source", "key").agg(F.sum("size").alias("size"))
    counts = units.groupBy("source").agg(F.count(F.lit(1)).alias("_units"))
    ratios = targets.join(counts, targets["source"].eqNullSafe(counts["source"])).select(
        targets["source"].alias("_source"),
        F.try_divide("target", "source_size").alias("_ratio"),
        F.ceil(F.col("_units") / block).alias("blocks"),
    )
    units = units.join(ratios, F.col("source").eqNullSafe(F.col("_source")))
    units = units.withColumn("p", F.col("_ratio") - F.floor("_ratio")).filter(
        (F.col("p") > _EPS) & (F.col("p") < 1 - _EPS)
    )
    level = units.select("source", "blocks", F.struct("size", "key", "p").alias("unit"))
    decided, depth = [], 0
    while True:
        salt = F.pmod(F.xxhash64(F.col("unit.key"), F.lit(seed + depth)), F.col("blocks"))
        largest_first = F.reverse(F.array_sort(F.collect_list("unit")))
        folded = level.groupBy("source", "blocks", salt.alias("block")).agg(_fold(largest_first, seed).alias("state"))
        folded = work.keep(folded, f"level{depth}")
        decided.append(folded.select(F.explode("state.done").alias("d")).select("d.key", "d.extra"))
        rest = folded.select("source", F.ceil(F.col("blocks") / block).alias("blocks"), F.col("state.carried").alias("unit"))
        # One number comes back, to tell whether any source still has several blocks.
        if (folded.agg(F.max("blocks")).first()[0] or 1) == 1:
            break
        level, depth = rest, depth + 1
    by_draw = (_uniform(F.col("unit.key"), F.lit(seed - 1)) < F.col("unit.p")).cast("int")
    decided.append(rest.select(F.col("unit.key").alias("key"), by_draw.alias("extra")))
    extras = reduce(DataFrame.unionByName, decided).filter("extra > 0").select(F.col("key").alias("_key"), F.col("extra").alias("_mix_extra"))

    marked = docs.select(*own, size.alias("size"), key.alias("_key")).join(extras, "_key", "left")
    per_source = targets.select(F.col("source").alias("_source"), "source_size", "target")
    marked = marked.join(per_source, F.col(source).eqNullSafe(F.col("_source")), "left")
    whole = F.when(F.col("source_size") > 0, F.floor(F.try_divide("target", "source_size") + _EPS)).otherwise(0)
    copies = (whole + F.coalesce("_mix_extra", F.lit(0))).cast("long")
    marked = marked.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return marked.select(*own, "size", "source_size", "target", "copies", "taken")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of a mix, each as often as it has copies."""
    times = F.expr("sequence(1, cast(copies as int))")
    return mixed.filter("copies > 0").select(*columns, F.explode(times).alias("_copy")).select(*columns)
