"""Basket values of checkout attempts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.functions.periods import in_period
from shopledger.functions.scalars import safe_ratio
from shopledger.operators.core import bin_of, metric_rows

CONTENT = (
    "struct<items:array<struct<unitPrice:double,quantity:double>>,"
    "discounts:array<struct<value:double,additionalFields:struct<type:string>>>,"
    "status:string,additionalFields:struct<subscribed:string>>"
)

# Right edges of the printed price bins, and the least value of a
# basket with free shipping, for one-time (False) and subscribed (True) baskets.
EDGES = {False: [0, 20, 35, 50, 65, 80, 95], True: [0, 15, 30, 45, 60, 75, 90]}
FREE_SHIPPING = {False: 35, True: 15}


def _total(array: str, wanted, amount) -> Column:
    """Sum over the wanted elements of an array, NULL (not 0) if it adds nothing."""

    def add(acc: Column, element: Column) -> Column:
        counts = wanted(element) & amount(element).isNotNull()
        return F.when(counts, F.coalesce(acc, F.lit(0.0)) + amount(element)).otherwise(acc)

    return F.aggregate(array, F.lit(None).cast("double"), add)


def _once(value: Column) -> Column:
    """Keeps an expensive value from being computed again in every later filter.

    The optimizer copies expressions into filters it pushes down; it does not
    look through a generated row.
    """
    return F.explode(F.array(value))


def _parsed(intents: DataFrame, start: str, end: str) -> DataFrame:
    """Checkouts of ``(start, end)`` that were not cancelled, with their parsed content and kind of basket."""
    subscribed = F.col("_c.additionalFields.subscribed")
    return (
        intents.filter(in_period(F.col("createdAt"), start, end, "()"))
        .select("orderNumber", "createdAt", _once(F.from_json("content", CONTENT)).alias("_c"))
        .filter(subscribed.isin("true", "false") & (F.col("_c.status") != "CANCELLED"))
        .withColumn("subscribed", subscribed == "true")
    )


def _valued(intents: DataFrame, start: str, end: str) -> DataFrame:
    """All parsed checkouts; those that are no basket of priced items have a NULL ``total_amount`` or ``units``."""

    def priced(item: Column) -> Column:
        return item["unitPrice"] > 0

    def deducted(discount: Column) -> Column:
        return ~discount["additionalFields"]["type"].eqNullSafe("shipping")

    value = _total("_c.items", priced, lambda i: i["unitPrice"] * i["quantity"]) - F.coalesce(
        _total("_c.discounts", deducted, lambda d: d["value"]), F.lit(0.0)
    )
    units = _total("_c.items", priced, lambda i: i["quantity"])
    return (
        _parsed(intents, start, end)
        .select(
            "subscribed",
            F.col("orderNumber").alias("order_number"),
            F.col("createdAt").alias("created_at"),
            _once(F.struct(value.alias("total_amount"), units.alias("units"))).alias("_v"),
        )
        .select("subscribed", "order_number", "created_at", "_v.*")
    )


def _is_basket(min_amount: Mapping[bool, float] | None) -> Column:
    whole = F.col("total_amount").isNotNull() & F.col("units").isNotNull()
    for subscribed, least in (min_amount or {}).items():
        whole &= (F.col("subscribed") != subscribed) | (F.col("total_amount") >= least)
    return whole


def basket_value(
    intents: DataFrame, start: str, end: str, min_amount: Mapping[bool, float] | None = None
) -> DataFrame:
    """Value and units of each basket: priced items less discounts other than shipping.

    The content is parsed once and summed in place, for one-time and subscribed
    baskets alike; ``min_amount`` sets a least value for either kind. A basket
    without priced items has no value and is dropped.
    """
    return _valued(intents, start, end).filter(_is_basket(min_amount))


def _grouped(baskets: DataFrame, *by: Column | str, counts: Column | None = None) -> DataFrame:
    """Figures of orders and attempts; rows where ``counts`` is not true only count in ``_orders``."""
    kind = F.when(F.col("order_number").isNotNull(), F.lit("orders")).otherwise(F.lit("attempts"))

    def counted(value: Column) -> Column:
        return value if counts is None else F.when(counts, value)

    return baskets.groupBy("subscribed", kind.alias("kind"), *by).agg(
        F.count(counted(F.lit(1))).alias("baskets"),
        F.avg(counted(F.col("total_amount"))).alias("avg_amount"),
        F.avg(counted(F.col("units"))).alias("avg_units"),
        F.min(counted(F.col("created_at"))).alias("_first"),
        F.max(counted(F.col("created_at"))).alias("_last"),
        F.count("order_number").alias("_orders"),
    )


def _days(first: Column, last: Column) -> Column:
    return F.datediff(last, first) + 1


def basket_summary(intents: DataFrame, start: str, end: str, min_amount: Mapping[bool, float] | None = None) -> DataFrame:
    """Means, baskets per day, their share of all orders per day, and how many attempts became orders.

    Baskets are those of ``basket_value``. Baskets per day count the days between the first and the
    last basket; all orders per day count the period with both ends and the checkouts that became
    orders, whatever their value. Contents are parsed once for both.
    """
    period_days = (date.fromisoformat(end[:10]) - date.fromisoformat(start[:10])).days + 1
    # Two rows per kind of basket: the orders and the attempts.
    whole = W.partitionBy("subscribed")
    totals = (
        _grouped(_valued(intents, start, end), counts=_is_basket(min_amount))
        .withColumns({"_every": F.sum("baskets").over(whole), "total_orders": F.sum("_orders").over(whole)})
        .filter("baskets > 0")
    )
    all_per_day = safe_ratio(F.col("total_orders"), F.lit(period_days))
    per_day = safe_ratio(F.col("baskets"), _days(F.col("_first"), F.col("_last")))
    is_order = F.col("kind") == "orders"
    # Orders and attempts list different figures; the others are left out.
    figures = {
        "avg_amount": F.col("avg_amount"),
        "avg_units": F.col("avg_units"),
        "per_day": per_day,
        "all_orders_per_day": F.when(is_order, all_per_day),
        "share_of_all_orders": F.when(is_order, safe_ratio(per_day, all_per_day)),
        "conversion": F.when(~is_order, safe_ratio(F.col("_every") - F.col("baskets"), F.col("_every"))),
    }
    return metric_rows(totals, figures, ["subscribed", "kind"]).filter(F.col("value").isNotNull())


def _labels(edges: Sequence[float]) -> Column:
    names = [f"{a} - {b}" for a, b in zip(edges, edges[1:])] + [f"> {edges[-1]}"]
    return F.array(*[F.lit(n) for n in names])


def basket_histogram(baskets: DataFrame, ladders: Mapping[bool, Sequence[float]] = EDGES) -> DataFrame:
    """Baskets per price bin: count, mean value, per day, share. Empty bins stay, without a mean.

    ``ladders`` holds the edges for one-time (``False``) and subscribed baskets.
    """
    one_time, subscribed = ladders[False], ladders[True]
    amount, is_subscribed = F.col("total_amount"), F.col("subscribed")
    position = F.when(is_subscribed, bin_of(amount, subscribed)).otherwise(bin_of(amount, one_time))
    binned = _with_rates(_grouped(baskets, position.alias("bin")))
    # A map of at most one entry per bin and kind, so that empty bins can be listed.
    entry = F.when(F.col("bin").isNotNull(), F.struct("bin", F.struct("baskets", "avg_amount", "per_day", "share")))
    filled = binned.groupBy("subscribed", "kind").agg(F.map_from_entries(F.collect_list(entry)).alias("_filled"))
    labels = F.when(is_subscribed, _labels(subscribed)).otherwise(_labels(one_time))
    cell = F.try_element_at("_filled", F.col("bin"))
    return filled.select("subscribed", "kind", "_filled", F.posexplode(labels).alias("bin", "label")).select(
        "subscribed",
        "kind",
        "bin",
        "label",
        F.coalesce(cell["baskets"], F.lit(0)).alias("baskets"),
        cell["avg_amount"].alias("avg_amount"),
        F.coalesce(cell["per_day"], F.lit(0.0)).alias("per_day"),
        F.coalesce(cell["share"], F.lit(0.0)).alias("share"),
    )


def basket_units(baskets: DataFrame) -> DataFrame:
    """The same per number of units."""
    shown = ["subscribed", "kind", "units", "baskets", "avg_amount", "per_day", "share"]
    return _with_rates(_grouped(baskets, "units")).select(*shown)


def _with_rates(groups: DataFrame) -> DataFrame:
    """Adds baskets per day and share of the kind.

    The windows see one row per bin (or number of units) of a kind.
    """
    kind = W.partitionBy("subscribed", "kind")
    days = _days(F.min("_first").over(kind), F.max("_last").over(kind))
    return groups.withColumn("per_day", safe_ratio(F.col("baskets"), days)).withColumn(
        "share", safe_ratio(F.col("baskets"), F.sum("baskets").over(kind))
    )
