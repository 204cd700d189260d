"""How much of the one-time business runs on a promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.functions.periods import day_of, in_period, month_of
from shopledger.functions.scalars import percent, safe_ratio
from shopledger.operators.core import metric_rows


def promo_daily(discounts: DataFrame, orders: DataFrame, start: str, end: str, name_prefix: str) -> DataFrame:
    """Discounted and all one-time orders per day of the order, both over their own period.

    A day appears for either kind; ``orders`` is NULL on days with discounts only.
    """
    one_time = orders.filter((F.col("status") != "CANCELLED") & (F.col("order_plan") != "SUBSCRIPTION"))
    used = (
        discounts.filter(F.col("name").startswith(name_prefix) & in_period(F.col("createdAt"), start, end, "()"))
        .groupBy(F.col("entityId").alias("id"))
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    discounted = (
        one_time.join(used, "id")
        .groupBy(day_of(F.col("created_at")).alias("day"))
        .agg(F.sum("uses").alias("discounted"))
    )
    every = (
        one_time.filter((F.col("recurrent") == 0) & in_period(F.col("created_at"), start, end, "()"))
        .groupBy(day_of(F.col("created_at")).alias("day"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return (
        every.unionByName(discounted, allowMissingColumns=True)
        .groupBy("day")
        .agg(F.sum("orders").alias("orders"), F.sum("discounted").alias("discounted"))
    )


def promo_comparison(daily: DataFrame) -> DataFrame:
    """Days with orders: how many of them were discounted, in percent."""
    discounted = F.coalesce("discounted", F.lit(0))
    return daily.filter(F.col("orders").isNotNull()).select(
        "day", "orders", discounted.alias("discounted"), percent(discounted, F.col("orders")).alias("discounted_pct")
    )


def promo_means(daily: DataFrame) -> DataFrame:
    """Average discounted and all orders per listed day and per listed month."""
    monthly = daily.groupBy(month_of(F.col("day")).alias("month")).agg(
        *[f(c).alias(f"{c}_{n}") for c in ("orders", "discounted") for n, f in (("sum", F.sum), ("days", F.count))]
    )
    means = monthly.agg(
        *[F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_days")).alias(f"{c}_per_day") for c in ("orders", "discounted")],
        *[F.avg(f"{c}_sum").alias(f"{c}_per_month") for c in ("orders", "discounted")],
    )
    return metric_rows(means, {c: F.coalesce(c, F.lit(0.0)) for c in means.columns})


def recent_or_all(daily: DataFrame, value: str, since: str) -> DataFrame:
    """The days from ``since`` on, or all days if there are none, for one series."""
    series = daily.filter(F.col(value).isNotNull()).select("day", value)
    latest = series.agg(F.max("day")).scalar()
    cut = F.lit(since).cast("date")
    return series.filter((F.col("day") >= cut) | (latest < cut))


def promo_monthly(comparison: DataFrame) -> DataFrame:
    """Monthly sums, averages per day and discounted share, with a TOTAL row."""
    per_month = comparison.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.sum("orders").alias("orders"), F.sum("discounted").alias("discounted"), F.count_distinct("day").alias("days")
    )
    table = (
        per_month.withColumn("month", F.explode(F.array("month", F.lit("TOTAL"))))
        .groupBy("month")
        .agg(*[F.sum(c).alias(c) for c in ("orders", "discounted", "days")])
    )
    return table.select(
        "month",
        "orders",
        "discounted",
        "days",
        safe_ratio(F.col("orders"), F.col("days")).alias("orders_per_day"),
        safe_ratio(F.col("discounted"), F.col("days")).alias("discounted_per_day"),
        percent(F.col("discounted"), F.col("orders")).alias("discounted_pct"),
    )


def trend_line(points: DataFrame, order: str, value: str, series: str | None = None) -> DataFrame:
    """A least-squares line over the position of the points, per series.

    NULL for a single point or a series of zeros. Points are periods of a
    report, so one series is a short, aggregated table.
    """
    rows = points if series else points.withColumn("series", F.lit("all"))
    key = series or "series"
    x = (F.row_number().over(W.partitionBy(key).orderBy(order)) - 1).cast("double")
    whole = W.partitionBy(key)
    placed = rows.withColumn("_x", x).withColumn("_y", F.col(value).cast("double"))
    fitted = F.regr_slope("_y", "_x").over(whole) * F.col("_x") + F.regr_intercept("_y", "_x").over(whole)
    return placed.withColumn("trend", F.when(F.max(F.col("_y") != 0).over(whole), fitted)).drop("_x", "_y")
