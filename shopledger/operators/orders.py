"""Order and sales KPIs per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.periods import day_of, in_period
from shopledger.functions.scalars import every_n, safe_ratio
from shopledger.operators.core import calendar, with_totals

VOID_STATUSES = ("CANCELLED", "PAYMENT_ERROR")  # fixed values

# Printed segments, by (who ordered, plan). NULL plan = any plan.
SEGMENTS = [
    ("new_subscription", "new", "SUBSCRIPTION"),
    ("new_oto", "new", "OTO"),
    ("new_mixed", "new", "MIXED"),
    ("new_all", "new", None),
    ("existing_subscription", "existing", "SUBSCRIPTION"),
    ("existing_oto", "existing", "OTO"),
    ("existing_mixed", "existing", "MIXED"),
    ("existing_all", "existing", None),
    ("recurrent", "recurrent", None),
]


def counted_orders(orders: DataFrame) -> DataFrame:
    """Orders that were neither cancelled nor failed."""
    return orders.filter(~F.col("status").isin(*VOID_STATUSES))


def valid_items(orders: DataFrame, items: DataFrame, excluded_items: Sequence[str]) -> DataFrame:
    """Orders with ``valid_items``: their units less the quantity of the excluded items.

    The excluded lines are summed per order before the join, so the join meets
    at most one row per order.
    """
    excluded = (
        items.filter(F.col("itemId").isin(list(excluded_items)))
        .groupBy(F.col("salesOrderId").alias("id"))
        .agg(F.sum("quantity").alias("_excluded"), F.lit(True).alias("_has_excluded"))
    )
    return (
        orders.join(excluded, "id", "left")
        .withColumn(
            "valid_items", F.when(F.col("_has_excluded"), F.col("units") - F.col("_excluded")).otherwise(F.col("units"))
        )
        .drop("_excluded", "_has_excluded")
    )


def daily_orders_kpi(
    orders: DataFrame, items: DataFrame, start: str, end: str, excluded_items: Sequence[str]
) -> DataFrame:
    """Revenue, orders and items per segment and day of ``[start, end)``, with a total row.

    The nine segments overlap; they are formed from sums per (who, plan, day),
    so the facts are read once. Days without orders are listed with zeros.
    """
    period = counted_orders(orders).filter(in_period(F.col("created_at"), start, end))
    who = (
        F.when(F.col("recurrent") == 1, F.lit("recurrent"))
        .when((F.col("recurrent") == 0) & (F.col("is_first_order") == 1), F.lit("new"))
        .when((F.col("recurrent") == 0) & (F.col("is_first_order") == 0), F.lit("existing"))
    )
    base = (
        valid_items(period, items, excluded_items)
        .groupBy(who.alias("who"), "order_plan", day_of(F.col("created_at")).alias("day"))
        .agg(
            F.sum("total").alias("revenue"),
            F.count("order_number").alias("orders"),
            F.count("total").alias("priced_orders"),
            F.sum("valid_items").alias("valid_items"),
        )
    )
    segments = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.col("who") == kind) & (F.lit(True) if plan is None else F.col("order_plan") == plan), F.lit(name)
                )
                for name, kind, plan in SEGMENTS
            ]
        )
    )
    measured = base.withColumn("segment", F.explode(segments))
    names = F.array(*[F.lit(name) for name, _, _ in SEGMENTS])
    last = F.date_sub(F.lit(end).cast("date"), 1)
    spine = (
        calendar(orders.sparkSession, start, end)
        .filter(F.col("day") <= last)
        .select(F.explode(names).alias("segment"), "day")
    )
    measures = ["revenue", "orders", "priced_orders", "valid_items"]
    daily = (
        measured.select("segment", "day", *measures)
        .unionByName(spine, allowMissingColumns=True)
        .groupBy("segment", "day")
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    )
    table = with_totals(daily, measures, keys=["segment"])
    # The total row counts priced orders, the daily rows count order numbers.
    orders_shown = F.when(F.col("row_type") == "total", F.col("priced_orders")).otherwise(F.col("orders"))
    return table.select(
        "segment",
        "row_type",
        "label",
        "revenue",
        orders_shown.alias("orders"),
        "valid_items",
        safe_ratio(F.col("valid_items"), orders_shown).alias("avg_items"),
        safe_ratio(F.col("revenue"), orders_shown).alias("avg_value"),
    )


def daily_sales_split(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Later orders per day, recurrent and not, with totals and means over the listed days."""
    daily = (
        counted_orders(orders)
        .filter(in_period(F.col("created_at"), start, end) & (F.col("is_first_order") != 1))
        .filter(F.col("recurrent").isin(0, 1))
        .groupBy(day_of(F.col("created_at")).alias("day"))
        .agg(
            F.count_if(F.col("recurrent") == 0).alias("daily_no_recurrent"),
            F.count_if(F.col("recurrent") == 1).alias("daily_recurrent"),
        )
    )
    return with_totals(daily, ["daily_no_recurrent", "daily_recurrent"], mean=True)


def expected_vs_obtained_renewals(
    subscriptions: DataFrame, orders: DataFrame, start: str, end: str, look_back_weeks: int = 8
) -> DataFrame:
    """Renewals due per day against renewals that came in, and their ratio.

    Due: active subscriptions updated in ``[start - look_back, end)``, one
    delivery interval after the update, if that falls in ``[start, end]``.
    """
    since = F.lit(start).cast("timestamp_ntz") - F.expr(f"make_dt_interval({7 * look_back_weeks})")
    updated = F.col("updatedAt").cast("timestamp_ntz")
    weeks = every_n(F.get_json_object("additionalFields", "$.frequency"))
    due = updated + F.make_dt_interval(weeks * 7)
    expected = (
        subscriptions.filter((F.col("status") == "ACTIVE") & (updated >= since) & (F.col("updatedAt") < F.lit(end)))
        .withColumn("due", due)
        .filter(in_period(F.col("due"), start, end, "[]"))
        .select(day_of(F.col("due")).alias("day"), F.lit(1).alias("expected"))
    )
    obtained = (
        orders.filter(in_period(F.col("created_at"), start, end))
        .filter((F.col("order_plan") == "SUBSCRIPTION") & (F.col("recurrent") == 1) & (F.col("units") == 1))
        .select(day_of(F.col("created_at")).alias("day"), F.lit(1).alias("obtained"))
    )
    daily = (
        expected.unionByName(obtained, allowMissingColumns=True)
        .groupBy("day")
        .agg(F.count("expected").alias("expected"), F.count("obtained").alias("obtained"))
    )
    return with_totals(daily, ["expected", "obtained"]).withColumn(
        "ratio", safe_ratio(F.col("obtained"), F.col("expected"))
    )
