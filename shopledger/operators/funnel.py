"""Step funnels per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.functions.scalars import step_name, step_number
from shopledger.operators.core import with_totals


#: Fixed value: columns of an export that are no step.
IGNORED = ("Ingreso Active users",)


def funnel_steps(wide: DataFrame, funnel: str, day: str = "Day", ignored: tuple[str, ...] = IGNORED) -> DataFrame:
    """A wide daily export (one ``"<k>. <step>"`` column per step) as rows of funnel, day, step, users."""
    steps = [c for c in wide.columns if c != day and c not in ignored]
    long = wide.select(day, *[F.col(f"`{c}`").cast("bigint").alias(c) for c in steps]).unpivot(
        [day], [F.col(f"`{c}`") for c in steps], "column", "users"
    )
    return long.select(
        F.lit(funnel).alias("funnel"),
        F.col(day).cast("int").alias("day"),
        step_number(F.col("column")).alias("step_no"),
        step_name(F.col("column")).alias("step"),
        "users",
    )


def funnel_daily(steps: DataFrame) -> DataFrame:
    """Users per step, day and in total, as a share of the first and of the previous step.

    Shares of the first step itself are NULL. Nothing over nothing is 0 against
    the previous step; something over nothing has no share (NULL).
    """
    keys = ["funnel", "step_no", "step"]
    daily = steps.groupBy(*keys, "day").agg(F.sum("users").alias("users"))
    dated = daily.withColumn("day", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")))
    table = with_totals(dated, ["users"], keys=keys)
    table = table.withColumn(
        "label",
        F.when(F.col("row_type") == "day", F.datediff(F.to_date("label"), F.lit("1970-01-01").cast("date")).cast("string"))
        .otherwise(F.col("label")),
    )
    # One window holds the steps of one funnel and day: a handful of rows.
    order = W.partitionBy("funnel", "row_type", "label").orderBy("step_no")
    first = F.first("users").over(order)
    previous = F.lag("users").over(order)
    is_first = F.row_number().over(order) == 1
    ratio = F.coalesce(F.try_divide(F.col("users").cast("double"), previous.cast("double")) * 100.0, F.when(F.coalesce("users", F.lit(0)) == 0, 0.0))
    return table.select(
        *keys,
        "row_type",
        "label",
        "users",
        F.when(~is_first, F.try_divide(F.col("users").cast("double"), first.cast("double")) * 100.0).alias("pct_of_first"),
        F.when(~is_first, F.when(ratio < 0, F.lit(0.0)).otherwise(ratio)).alias("pct_of_previous"),
    )


def funnel_summary(steps: DataFrame) -> DataFrame:
    """Per funnel: users of the first step, and each later step's share of it over all days."""
    totals = funnel_daily(steps).filter(F.col("row_type") == "total")
    return totals.select("funnel", "step_no", "step", "users", F.coalesce("pct_of_first", F.lit(100.0)).alias("pct_of_first"))
