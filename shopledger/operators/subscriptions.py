"""Subscription mix, refills, add-ons and the acquisition survey."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.periods import in_period
from shopledger.functions.scalars import percent
from shopledger.operators.core import metric_rows


def subscription_mix(
    subscriptions: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    start: str,
    end: str,
    mini_plans: Sequence[str],
    regular_plans: Sequence[str],
    oto_items: Sequence[str],
) -> DataFrame:
    """Mini and regular subscriptions, how many are new, and units sold one-time.

    New mini subscriptions are counted per first order, regular ones once each.
    """
    kind = F.when(F.col("plan_id").isin(list(mini_plans)), F.lit("mini")).when(
        F.col("plan_id").isin(list(regular_plans)), F.lit("regular")
    )
    created = subscriptions.filter(
        in_period(F.col("created_at"), start, end) & (F.col("status") != "CANCELLED")
    ).select("id", kind.alias("kind")).filter(F.col("kind").isNotNull())
    first_orders = (
        orders.filter((F.col("is_first_order") == 1) & F.col("subscription_id").isNotNull())
        .groupBy(F.col("subscription_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("first_orders"))
    )
    mini, regular = F.col("kind") == "mini", F.col("kind") == "regular"
    subs = created.join(first_orders, "id", "left").agg(
        F.count(F.when(mini, F.col("id"))).alias("mini"),
        F.count(F.when(regular, F.col("id"))).alias("regular"),
        F.coalesce(F.sum(F.when(mini, F.col("first_orders"))), F.lit(0)).alias("new_mini"),
        F.countDistinct(F.when(regular & (F.col("first_orders") > 0), F.col("id"))).alias("new_regular"),
    )
    sold = orders.filter(
        in_period(F.col("created_at"), start, end)
        & (F.col("status") != "CANCELLED")
        & (F.col("order_plan") != "SUBSCRIPTION")
    ).select(F.col("id").alias("salesOrderId"))
    oto = (
        items.filter(F.col("itemId").isin(list(oto_items)))
        .join(sold, "salesOrderId")
        .agg(F.coalesce(F.sum("quantity"), F.lit(0)).alias("oto"))
    )
    names = ["mini", "regular", "new_mini", "new_regular", "oto"]
    totals = subs.unionByName(oto, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in names])
    both = F.col("mini") + F.col("regular")
    return metric_rows(
        totals,
        {
            "mini_subscriptions": F.col("mini"),
            "subscriptions": F.col("regular"),
            "mini_pct": F.round(percent(F.col("mini"), both), 2),
            "oto_pct": F.round(percent(F.col("oto"), both + F.col("oto")), 2),
            "oto_units": F.col("oto"),
            "new_mini_subscriptions": F.col("new_mini"),
            "new_subscriptions": F.col("new_regular"),
            "existing_mini_subscriptions": F.col("mini") - F.col("new_mini"),
            "existing_subscriptions": F.col("regular") - F.col("new_regular"),
        },
    )


def addon_subscriptions(
    subscriptions: DataFrame,
    subscription_items: DataFrame,
    item_groups: DataFrame,
    start: str,
    end: str,
    groups: Mapping[str, Sequence[str]],
    endless: int = -1,
) -> DataFrame:
    """Subscription lines without an end date, per named set of item groups."""
    names = F.array_compact(
        F.array(*[F.when(F.col("itemGroupId").isin(list(ids)), F.lit(n)) for n, ids in groups.items()])
    )
    grouped = item_groups.select("itemId", F.explode(names).alias("addon"))
    # Lines are counted per subscription and add-on before they meet the subscriptions.
    lines = (
        subscription_items.filter(F.col("timesRemaining") == endless)
        .join(grouped, "itemId")
        .groupBy(F.col("subscriptionId").alias("id"), "addon")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    recent = subscriptions.filter(in_period(F.col("createdAt"), start, end, "()")).select("id")
    return lines.join(recent, "id").groupBy("addon").agg(F.sum("lines").alias("subscriptions"))


def _shipped(orders: DataFrame, start: str, end: str) -> DataFrame:
    return orders.filter(in_period(F.col("created_at"), start, end, "()") & (F.col("status") != "CANCELLED"))


def _one_line_per_order(items: DataFrame, orders: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The line with the lowest item id stands for the order."""
    lines = items.groupBy("salesOrderId", *keys).agg(F.min(F.struct("itemId", "quantity")).alias("line"))
    return lines.join(orders.withColumnRenamed("id", "salesOrderId"), "salesOrderId").withColumn(
        "quantity", F.col("line.quantity")
    )


def category_refill(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    start: str,
    end: str,
    refill_categories: Sequence[str],
    oto_categories: Sequence[str],
) -> DataFrame:
    """Non-recurrent orders with a refill item, and one-time orders of a category."""
    shipped = _shipped(orders, start, end)
    known = customers.select(F.col("id").alias("customer_id")).distinct()
    refill_orders = (
        shipped.filter(F.col("recurrent") == 0)
        .join(known, "customer_id", "left_semi")
        .select("id", "order_number", "is_first_order")
    )
    refills = _one_line_per_order(
        items.filter(F.col("category").isin(list(refill_categories))), refill_orders
    ).agg(
        F.count("order_number").alias("refill_orders"),
        F.coalesce(F.sum("is_first_order"), F.lit(0)).alias("refill_new_customers"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("refill_units"),
    )
    oto = (
        items.filter(F.col("category").isin(list(oto_categories)))
        .select(F.col("salesOrderId").alias("id"), "category")
        .distinct()
        .join(shipped.filter(F.col("order_plan") == "OTO"), "id")
        .select("order_number", "created_at", "category", "is_first_order")
        .distinct()
        .agg(
            F.countDistinct("order_number").alias("oto_orders"),
            F.coalesce(F.sum("is_first_order"), F.lit(0)).alias("oto_new_customers"),
        )
    )
    names = ["refill_orders", "refill_new_customers", "refill_units", "oto_orders", "oto_new_customers"]
    totals = refills.unionByName(oto, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in names])
    return metric_rows(totals, {n: F.col(n) for n in names})


def upsize_attach(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    start: str,
    end: str,
    addons: Mapping[str, Mapping[str, Sequence[str]]],
    base_categories: Sequence[str],
) -> DataFrame:
    """Per add-on: orders it could go with, orders that have it, and pieces; plus a total row.

    ``addons`` maps a name to ``{"items": [...], "base": [categories]}``. An
    add-on with one base category counts that category's orders, one with
    several counts distinct order numbers over them.
    """
    shipped = _shipped(orders, start, end)
    known = customers.select(F.col("id").alias("customer_id")).distinct()
    names = F.array_compact(
        F.array(*[F.when(F.col("itemId").isin(list(a["items"])), F.lit(n)) for n, a in addons.items()])
    )
    lines = items.select("salesOrderId", "itemId", "quantity", F.explode(names).alias("addon"))
    attached = (
        _one_line_per_order(
            lines, shipped.join(known, "customer_id", "left_semi").select("id", "order_number"), ["addon"]
        )
        .groupBy("addon")
        .agg(F.countDistinct("order_number").alias("upsized_orders"), F.sum("quantity").alias("pieces"))
    )
    based = (
        items.filter(F.col("category").isin(list(base_categories)))
        .select(F.col("salesOrderId").alias("id"), "category")
        .distinct()
        .join(shipped.filter(F.col("order_plan") == "OTO"), "id")
        .select("order_number", "created_at", "category")
        .distinct()
    )
    bases = {n: list(a["base"]) for n, a in addons.items()} | {"total": list(base_categories)}
    in_base = F.array_compact(
        F.array(*[F.when(F.col("category").isin(cats), F.lit(n)) for n, cats in bases.items()])
    )
    single = [n for n, cats in bases.items() if len(cats) == 1]
    base = (
        based.select("order_number", F.explode(in_base).alias("addon"))
        .groupBy("addon")
        .agg(F.count(F.lit(1)).alias("_rows"), F.countDistinct("order_number").alias("_numbers"))
        .select(
            "addon", F.when(F.col("addon").isin(single), F.col("_rows")).otherwise(F.col("_numbers")).alias("base_orders")
        )
    )
    with_total = attached.withColumn("addon", F.explode(F.array("addon", F.lit("total"))))
    listed = F.array(*[F.lit(n) for n in bases])
    spine = orders.sparkSession.range(0, 1, 1, 1).select(F.explode(listed).alias("addon"))
    measures = ["base_orders", "upsized_orders", "pieces"]
    return (
        spine.unionByName(with_total, allowMissingColumns=True)
        .unionByName(base, allowMissingColumns=True)
        .groupBy("addon")
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    )


def acquisition_survey(
    orders: DataFrame, answers: DataFrame, start: str, end: str, sources: Sequence[str]
) -> DataFrame:
    """New customers' orders, respondents, and answers per listed source."""
    new_orders = (
        orders.filter(
            in_period(F.col("created_at"), start, end, "[]")
            & (F.col("status") != "CANCELLED")
            & (F.col("is_first_order") == 1)
        )
        .select("order_number", "created_at")
        .distinct()
        .agg(F.count("order_number").alias("value"))
        .select(F.lit("new_customer_orders").alias("metric"), "value")
    )
    answered = answers.filter(in_period(F.col("createdAt"), start, end, "()"))
    respondents = (
        answered.select("customerId").distinct().agg(F.count(F.lit(1)).alias("value"))
        .select(F.lit("respondents").alias("metric"), "value")
    )
    per_source = metric_rows(
        answered.agg(*[F.count_if(F.col("source") == s).alias(s) for s in sources]), {s: F.col(s) for s in sources}
    ).select(F.concat(F.lit("source:"), "metric").alias("metric"), F.col("value").cast("bigint").alias("value"))
    return new_orders.unionByName(respondents).unionByName(per_source)
