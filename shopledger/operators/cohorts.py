"""Monthly cohorts of first-time subscribers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.answers import answer_to, labelled, parsed
from shopledger.functions.periods import month_of
from shopledger.operators.core import calendar
from shopledger.operators.orders import counted_orders


def last_one_time_order(orders: DataFrame) -> Column:
    """The day of the last one-time order of anybody: a reporting date from one narrow scan."""
    one_time = counted_orders(orders).filter(F.col("order_plan") == "OTO")
    return one_time.agg(F.to_date(F.max("created_at"))).scalar()


def subscriber_facts(
    orders: DataFrame,
    customers: DataFrame,
    subscriptions: DataFrame,
    cancellations: DataFrame,
    raw_items: DataFrame,
    sales_orders: DataFrame,
    first_from: str,
    first_to: str,
    kit_pattern: str,
    experience: Mapping[str, Sequence[str]],
    variables: Sequence[int],
    as_of: str | Column,
) -> DataFrame:
    """One row per customer whose first subscription order lies between two dates (both included).

    All order figures of a customer come from one aggregation. Activity is
    judged as of ``as_of``, the reporting date (see ``last_one_time_order``).
    """
    subscribed = F.col("order_plan").isin("SUBSCRIPTION", "MIXED")
    # Sorted by time, then highest total: the first element carries both.
    opening = F.struct("created_at", (-F.coalesce("total", F.lit(0))).alias("minus_total"))
    per_customer = counted_orders(orders).groupBy("customer_id").agg(
        F.min(F.when(subscribed, opening)).alias("_opening"),
        F.min(F.when(subscribed, F.struct("created_at", "id")))["id"].alias("first_order_id"),
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("revenue"),
        F.max(F.when(F.col("order_plan") == "OTO", F.col("created_at"))).alias("_last_oto"),
    )
    cohort = F.to_date("_opening.created_at")
    members = (
        per_customer.withColumn("cohort", cohort)
        .filter(F.col("cohort").between(F.lit(first_from).cast("date"), F.lit(first_to).cast("date")))
        .join(customers.select(F.col("id").alias("customer_id")).distinct(), "customer_id", "left_semi")
        .select(
            "customer_id",
            "cohort",
            "first_order_id",
            "orders",
            "revenue",
            (F.col("revenue") + F.coalesce("_opening.minus_total", F.lit(0))).alias("repurchase_revenue"),
            F.to_date("_last_oto").alias("last_oto_date"),
        )
    )
    cancelled = cancellations.groupBy(F.col("subscriptionId").alias("id")).agg(F.max("createdAt").alias("_cancelled"))
    per_subscriber = (
        subscriptions.select("id", F.col("customerId").alias("customer_id"), "status")
        .join(cancelled, "id", "left")
        .groupBy("customer_id")
        .agg(
            F.max(F.col("status") != "CANCELLED").alias("has_active_subscription"),
            F.to_date(F.max("_cancelled")).alias("last_cancellation_date"),
        )
    )
    kit = (
        raw_items.filter(F.col("itemId").cast("string").like(kit_pattern))
        .groupBy(F.col("salesOrderId").alias("first_order_id"))
        .agg(
            F.min(F.struct("itemId", F.get_json_object("additionalFields", "$.diagnostic").alias("answers")))[
                "answers"
            ].alias("_kit_answers")
        )
    )
    whole = sales_orders.select(
        F.col("id").alias("first_order_id"),
        F.get_json_object("additionalFields", "$.diagnostic").alias("_order_answers"),
    )
    latest = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return (
        members.join(per_subscriber, "customer_id", "left")
        .join(kit, "first_order_id", "left")
        .join(whole, "first_order_id", "left")
        .withColumn("_answers", parsed(F.coalesce("_kit_answers", "_order_answers")))
        .withColumn("experience", labelled(answer_to(F.col("_answers"), variables), experience, default=None))
        .withColumn("has_active_subscription", F.coalesce("has_active_subscription", F.lit(False)))
        .withColumn("as_of", latest)
        .drop("_kit_answers", "_order_answers", "_answers")
    )


def with_activity(facts: DataFrame) -> DataFrame:
    """Adds ``is_active``: an active subscription, a one-time order within 365 days, or a cancellation within 90."""
    latest = F.col("as_of")
    ordered = (F.col("last_oto_date") > F.col("cohort")) & (F.col("last_oto_date") >= F.date_sub(latest, 365))
    left = F.col("last_cancellation_date") >= F.date_sub(latest, 90)
    active = F.col("has_active_subscription") | F.coalesce(ordered, F.lit(False)) | F.coalesce(left, F.lit(False))
    return facts.withColumn("is_active", active)


def investor_cohorts(facts: DataFrame, month_from: str, month_to: str, experience: Sequence[str]) -> DataFrame:
    """Users, orders and revenue per cohort month, for all members and per experience.

    ``facts`` comes from ``with_activity``. Months without members show zeros.
    """
    everyone = "all"
    rows = facts.withColumn("cohort_month", month_of(F.col("cohort"))).withColumn(
        "repurchases", F.greatest(F.col("orders") - 1, F.lit(0))
    )
    known = F.when(F.col("experience").isin(list(experience)), F.col("experience"))
    measures = {
        "new_users": F.count(F.lit(1)),
        "orders": F.sum("orders"),
        "revenue": F.sum("revenue"),
        "repurchasing_users": F.count_if(F.col("orders") >= 2),
        "repurchase_orders": F.sum("repurchases"),
        "repurchase_revenue": F.sum("repurchase_revenue"),
        "active_users": F.count_if("is_active"),
        "active_repurchase_orders": F.sum(F.when(F.col("is_active"), F.col("repurchases")).otherwise(0)),
    }
    # Grouped by experience first; "all" is the sum of those few rows.
    per_month = (
        rows.groupBy("cohort_month", known.alias("experience"))
        .agg(*[m.alias(n) for n, m in measures.items()])
        .withColumn("split", F.explode(F.array_compact(F.array(F.lit(everyone), "experience"))))
        .drop("experience")
    )
    splits = F.array(*[F.lit(s) for s in (everyone, *experience)])
    months = calendar(facts.sparkSession, month_from, month_to, "1 month", "cohort_month").select(
        F.explode(splits).alias("split"), "cohort_month"
    )
    in_months = F.col("cohort_month").between(F.lit(month_from).cast("date"), F.lit(month_to).cast("date"))
    return (
        months.unionByName(per_month.filter(in_months), allowMissingColumns=True)
        .groupBy("split", "cohort_month")
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in measures])
    )
