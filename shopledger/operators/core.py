"""Building blocks shared by the reports.

Blocks that follow rows in time order (numbering, previous value, last fact
before an event) work per key *and hour* first and then carry a small hourly
summary along the key. A single key may hold a third of all rows: its hours are
spread over the cluster, and only one row per hour has to meet in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BEFORE_ALL = "0001-01-01"
_TIES_PER_SLOT = 10_000


def small_table(spark: SparkSession, columns: Mapping[str, Sequence], schema: str) -> DataFrame:
    """A caller-given list as a local relation: Spark knows its size and broadcasts it by itself."""
    return spark.createDataFrame(pa.table({n: pa.array(v) for n, v in columns.items()}), schema)


def calendar(spark: SparkSession, start: str, end: str, step: str = "1 day", name: str = "day") -> DataFrame:
    """Every date from ``start`` to ``end``, both included."""
    dates = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval {step}"))
    return spark.range(0, 1, 1, 1).select(F.explode(dates).alias(name))


def metric_rows(df: DataFrame, metrics: dict[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """One row per metric: ``keep..., metric, value``."""
    cells = [F.struct(F.lit(n).alias("metric"), c.cast("double").alias("value")) for n, c in metrics.items()]
    return df.select(*keep, F.explode(F.array(*cells)).alias("cell")).select(*keep, "cell.metric", "cell.value")


def with_totals(
    daily: DataFrame,
    measures: Sequence[str],
    day: str = "day",
    keys: Sequence[str] = (),
    mean: bool = False,
) -> DataFrame:
    """Daily rows plus a total row (and a row of daily means) per ``keys``.

    ``row_type`` tells the rows apart and ``label`` is the printed date.
    ``daily`` holds one row per day, so repeating it two or three times is cheap.
    """
    kinds = ["day", "total"] + (["mean"] if mean else [])
    leveled = daily.withColumn("row_type", F.explode(F.array(*[F.lit(k) for k in kinds])))
    leveled = leveled.withColumn(
        "label",
        F.when(F.col("row_type") == "day", F.date_format(F.col(day), "yyyy-MM-dd"))
        .when(F.col("row_type") == "total", F.lit("Total"))
        .otherwise(F.lit("Mean")),
    )
    aggs = []
    for m in measures:
        total = F.sum(m)
        if mean:
            total = F.when(F.col("row_type") == "mean", F.avg(m)).otherwise(total.cast("double"))
        aggs.append(total.alias(m))
    return leveled.groupBy(*keys, "row_type", "label").agg(*aggs)


def _hour(ts: Column) -> Column:
    """The hour of a row (missing times first): a decade of one key is at most some 90,000 hours."""
    return F.coalesce(F.date_trunc("hour", ts), F.lit(_BEFORE_ALL).cast("timestamp"))


def _slot(df: DataFrame, ts: str, tie: Sequence[str]) -> Column:
    """Where a row of a key stands, in the order of ``ts, tie``: its hour, or without a time its range of ties.

    Rows without a time are spread by a whole-number tie, so that a key which has many of them does
    not put them into one task.
    """
    among_missing = F.lit(0).cast("long")
    if tie and isinstance(df.schema[tie[0]].dataType, T.IntegralType):
        part = F.coalesce(F.floor(F.col(tie[0]) / _TIES_PER_SLOT).cast("long"), F.lit(-(1 << 62)))
        among_missing = F.when(F.col(ts).isNull(), part).otherwise(among_missing)
    return F.struct(_hour(F.col(ts)).alias("hour"), among_missing.alias("part"))


def numbered(
    df: DataFrame, key: Sequence[str], ts: str, tie: Sequence[str], name: str, first: Sequence[str] = ()
) -> DataFrame:
    """``row_number()`` per key in ``ts, tie`` order (missing times first).

    The columns ``first`` of each key's first row come along as ``first_<column>``.
    """
    rows = df.withColumn("_slot", _slot(df, ts, tie))
    opening = F.min(F.struct(F.col(ts), *tie, *first)) if first else F.lit(None)
    per_slot = rows.groupBy(*key, "_slot").agg(F.count(F.lit(1)).alias("_rows"), opening.alias("_opening"))
    earlier = W.partitionBy(*key).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    openings = W.partitionBy(*key).orderBy("_slot")
    per_slot = per_slot.select(
        *key,
        "_slot",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        *[F.first("_opening").over(openings)[c].alias(f"first_{c}") for c in first],
    )
    inside = W.partitionBy(*key, "_slot").orderBy(F.col(ts), *tie)
    return (
        rows.withColumn("_position", F.row_number().over(inside))
        .join(per_slot, [*key, "_slot"])
        .withColumn(name, (F.col("_offset") + F.col("_position")).cast("int"))
        .drop("_slot", "_position", "_offset")
    )


def change_points(df: DataFrame, key: Sequence[str], ts: str, tie: Sequence[str], value: str, name: str) -> DataFrame:
    """Rows whose ``value`` differs from that of the row before, per key in ``ts, tie`` order, from one evaluation.

    Adds ``name``, the value before (NULL for a key's first row and after a NULL, which both count
    as changes), and ``several``: whether the key has more than one value. Each key and hour is
    folded into a summary (changes inside, last, least and greatest value) where its rows are
    sorted anyway; the summaries meet along the key. A NULL after a value is no change.
    """
    rows = df.withColumn("_slot", _slot(df, ts, tie))
    inside = W.partitionBy(*key, "_slot").orderBy(F.col(ts), *tie)
    rows = rows.withColumns({"_opens": F.row_number().over(inside) == 1, "_before": F.lag(value).over(inside)})
    changed = F.col("_opens") | F.col("_before").isNull() | (F.col(value) != F.col("_before"))
    others = [c for c in df.columns if c not in key]
    summary = rows.groupBy(*key, "_slot").agg(
        F.collect_list(F.when(changed, F.struct(*others, "_opens", "_before"))).alias("_changes"),
        F.max_by(F.struct(value), F.struct(F.col(ts), *tie)).alias("_last"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
    )
    along, whole = W.partitionBy(*key).orderBy("_slot"), W.partitionBy(*key)
    summary = summary.select(
        *key,
        "_changes",
        F.lag("_last").over(along)[value].alias("_carried"),
        F.coalesce(F.min("_low").over(whole) != F.max("_high").over(whole), F.lit(False)).alias("several"),
    )
    found = summary.select(*key, "several", "_carried", F.inline("_changes"))
    before = F.when(F.col("_opens"), F.col("_carried")).otherwise(F.col("_before"))
    found = found.select(*df.columns, before.alias(name), "several")
    return found.filter((F.col(value) != F.col(name)) | F.col(name).isNull())


def last_before(
    events: DataFrame,
    facts: DataFrame,
    key: str,
    event_ts: str,
    fact_ts: str,
    fact_tie: Sequence[str],
    payload: Sequence[str],
) -> DataFrame:
    """Each event with the ``payload`` of the latest fact strictly before it.

    Events without an earlier fact are dropped. Both sides are sorted together
    once, so the work is linear in their rows even where one key has many of
    each. ``payload`` names must not occur in ``events``.
    """
    fact = F.struct(*[F.col(c) for c in dict.fromkeys([fact_ts, *fact_tie, *payload])])
    left = events.filter(F.col(event_ts).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(event_ts).alias("_ts"),
        F.lit(0).alias("_kind"),
        F.struct("*").alias("_event"),
    )
    right = facts.filter(F.col(fact_ts).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(fact_ts).alias("_ts"), F.lit(1).alias("_kind"), fact.alias("_fact")
    )
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_slot", _hour(F.col("_ts")))

    # At one instant events sort ahead of facts, hence "strictly before".
    inside = (
        W.partitionBy("_key", "_slot").orderBy("_ts", "_kind", "_fact").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    seen = both.withColumn("_seen", F.last("_fact", ignorenulls=True).over(inside)).filter(F.col("_kind") == 0)

    per_slot = both.groupBy("_key", "_slot").agg(F.max("_fact").alias("_fact"))
    earlier_slots = W.partitionBy("_key").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    per_slot = per_slot.select(
        "_key", "_slot", F.last("_fact", ignorenulls=True).over(earlier_slots).alias("_carried")
    )
    found = seen.join(per_slot, ["_key", "_slot"]).withColumn("_found", F.coalesce("_seen", "_carried"))
    return found.filter(F.col("_found").isNotNull()).select(
        "_event.*", *[F.col("_found")[c].alias(c) for c in payload]
    )


def latest_two(df: DataFrame, key: Sequence[str], ts: str, tie: str) -> DataFrame:
    """One row per key: its latest and second latest ``ts``.

    ``row_number() <= 2`` is cut down to two rows per key before the shuffle.
    """
    order = W.partitionBy(*key).orderBy(F.col(ts).desc(), F.col(tie).desc())
    top = df.select(*key, ts, tie).withColumn("_n", F.row_number().over(order)).filter("_n <= 2")
    return top.groupBy(*key).agg(
        F.max(F.when(F.col("_n") == 1, F.col(ts))).alias("last_ts"),
        F.max(F.when(F.col("_n") == 2, F.col(ts))).alias("second_last_ts"),
    )


def value_counts(df: DataFrame, value: str, name: str = "count") -> DataFrame:
    """Frequencies of the present values, most frequent first."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.col(value))
    )


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Index of the right-closed bin ``(edges[i], edges[i+1]]``; the first bin includes its left edge.

    Values above the last edge fall into one more bin, values below the first into none.
    """
    result = F.when(value < edges[0], F.lit(None).cast("int"))
    for i, upper in enumerate(edges[1:]):
        result = result.when(value <= upper, F.lit(i))
    return result.when(value > edges[-1], F.lit(len(edges) - 1))
