"""Collecting report figures into long tracker tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.scalars import lookup_key, percent_number


def as_metrics(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``(metric, value)`` rows of a wide table: the metric is named after the keys and the measure. No row without a value."""
    name = lambda m: F.concat_ws(".", *[F.col(k).cast("string") for k in keys], F.lit(m))
    cells = [F.struct(name(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in measures]
    return df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())


def kpi_tracker(period: str, sections: Mapping[str, DataFrame]) -> DataFrame:
    """``(period, section, metric, value)`` from tables of metric and value."""
    parts = [
        df.select(
            F.lit(period).alias("period"), F.lit(name).alias("section"), "metric", F.col("value").cast("double").alias("value")
        )
        for name, df in sections.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def tracker_update(tracker: DataFrame, fresh: DataFrame) -> DataFrame:
    """The tracker with the figures of ``fresh`` replacing those of the same key."""
    keys = ["period", "section", "metric"]
    return tracker.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)


def tracker_merge(
    master: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] = (),
    name: str = "value",
    loose: Sequence[str] = (),
) -> DataFrame:
    """The master's rows with ``value`` looked up in ``source`` by trimmed keys.

    Where several source rows match, the first in ``order`` wins. ``loose`` keys
    ignore case, spaces and hyphens. Percent texts are read as numbers.
    """
    def key(column: str):
        text = F.trim(F.col(column).cast("string"))
        return lookup_key(text) if column in loose else text

    hidden = [f"_key_{k}" for k in keys]
    position = F.struct(*[F.col(c) for c in (*order, value)])
    first = (
        source.select(*[key(k).alias(h) for k, h in zip(keys, hidden)], position.alias("_at"))
        .groupBy(*hidden)
        .agg(F.min("_at")[value].alias("_value"))
    )
    number = percent_number(F.col("_value").cast("string"))
    return (
        master.withColumns({h: key(k) for k, h in zip(keys, hidden)})
        .join(first, hidden, "left")
        .withColumn(name, number)
        .drop(*hidden, "_value")
    )
