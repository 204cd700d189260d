"""Why subscriptions are cancelled: by segment, item, experience and month."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.functions.answers import answer_to, code_by_precedence, first_code, labelled, parsed
from shopledger.functions.periods import day_of, in_period, month_of
from shopledger.functions.scalars import deviation, deviation_flag, percent, reason_root, safe_ratio
from shopledger.operators.core import last_before, small_table
from shopledger.operators.orders import counted_orders

Labels = Mapping[str, Sequence[str]]


def _diagnostic() -> Column:
    return F.get_json_object("additionalFields", "$.diagnostic")


def cancellation_base(
    cancellations: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    raw_items: DataFrame,
    sales_orders: DataFrame,
    start: str,
    end: str,
    listed_items: Sequence,
    kit_items: Sequence,
    segment_codes: Sequence[int],
    experience: Labels,
    experience_variables: Sequence[int],
    dedupe: bool = True,
) -> DataFrame:
    """Cancellations of ``[start, end]`` whose last valid order before holds a listed item.

    The questionnaire is that of the order's kit line, else of the order. With
    several kit lines the lowest item id is taken; ``dedupe=False`` keeps one
    row per kit line instead, as the plain left join does.
    """
    cancels = cancellations.filter(in_period(F.col("createdAt"), start, end, "[]")).select(
        F.col("id").alias("cancel_id"), F.col("subscriptionId").alias("subscription_id"), "reason", F.col("createdAt").alias("cancelled_at")
    )
    facts = counted_orders(orders).select("id", "order_number", "subscription_id", "created_at").withColumnRenamed("id", "order_id")
    found = last_before(
        cancels, facts, "subscription_id", "cancelled_at", "created_at", ["order_id"], ["order_id", "order_number"]
    )
    # The listed items are a short list, so the set per order is bounded by it.
    listed = (
        items.filter(F.col("itemId").isin(list(listed_items)))
        .groupBy(F.col("salesOrderId").alias("order_id"))
        .agg(F.array_sort(F.collect_set("itemId")).alias("listed_items"))
    )
    kit = raw_items.filter(F.col("itemId").isin(list(kit_items))).select(
        F.col("salesOrderId").alias("order_id"), "itemId", _diagnostic().alias("_kit_answers")
    )
    if dedupe:
        kit = kit.groupBy("order_id").agg(F.min(F.struct("itemId", "_kit_answers"))["_kit_answers"].alias("_kit_answers"))
    whole = sales_orders.select(F.col("id").alias("order_id"), _diagnostic().alias("_order_answers"))
    answers = F.col("_answers")
    return (
        found.join(listed, "order_id")
        .join(kit.drop("itemId"), "order_id", "left")
        .join(whole, "order_id", "left")
        .withColumn("_answers", parsed(F.coalesce("_kit_answers", "_order_answers")))
        .select(
            "cancel_id",
            "subscription_id",
            "reason",
            "cancelled_at",
            "order_id",
            "order_number",
            "listed_items",
            first_code(answers, segment_codes).alias("segment_code"),
            labelled(answer_to(answers, experience_variables), experience).alias("experience"),
        )
    )


def cancel_by_last_order(
    cancellations: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    subscriptions: DataFrame,
    start: str,
    end: str,
    category: str,
    segment_codes: Sequence[int],
    listed_items: Sequence = (),
) -> DataFrame:
    """Cancellations of ``[start, end)`` with the listed items of their last order, if it holds the category.

    Orders of any status count; orders tied for last all count. The segment is
    the first of ``segment_codes`` found in the subscription's answers. An empty
    ``listed_items`` keeps every item.
    """
    cancels = (
        cancellations.filter(in_period(F.col("createdAt"), start, end))
        .select(F.col("subscriptionId").alias("subscription_id"), "reason", F.col("createdAt").alias("cancelled_at"))
        .distinct()
    )
    facts = orders.select(F.col("id").alias("order_id"), "order_number", "subscription_id", F.col("created_at").alias("ordered_at"))
    last = last_before(
        cancels, facts.select("subscription_id", "ordered_at"), "subscription_id", "cancelled_at", "ordered_at", [], ["ordered_at"]
    )
    wanted = F.lit(True) if not listed_items else F.col("itemId").isin(list(listed_items))
    in_category = items.filter(F.col("category") == category).select(F.col("salesOrderId").alias("order_id")).distinct()
    lines = items.filter(wanted).select(F.col("salesOrderId").alias("order_id"), F.col("itemId").alias("item_id")).distinct()
    segment = subscriptions.select(
        F.col("id").alias("subscription_id"), code_by_precedence(F.col("additionalFields"), segment_codes).alias("segment_code")
    )
    return (
        last.join(facts, ["subscription_id", "ordered_at"])
        .join(in_category, "order_id", "left_semi")
        .join(lines, "order_id")
        .join(segment, "subscription_id", "left")
        .select(
            "subscription_id",
            reason_root(F.col("reason")).alias("reason"),
            "cancelled_at",
            "order_id",
            "order_number",
            "ordered_at",
            "segment_code",
            "item_id",
        )
    )


def cancellation_level(item_rows: DataFrame) -> DataFrame:
    """One row per (subscription, moment) of ``cancel_by_last_order``."""
    first = F.min(F.struct("reason", "order_number", "ordered_at", "segment_code"))
    return (
        item_rows.groupBy("subscription_id", "cancelled_at")
        .agg(first.alias("first"))
        .select("subscription_id", "cancelled_at", F.col("first.*"))
        .withColumn("cancel_id", F.concat_ws("@", F.col("subscription_id").cast("string"), F.col("cancelled_at").cast("string")))
    )


def _with_shares(table: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Adds each measure's percentage of its column total, rounded to 2. One row per reason: a window over all of them."""
    everything = W.partitionBy()
    return table.withColumns({f"{m}_pct": F.round(percent(F.col(m), F.sum(m).over(everything)), 2) for m in measures})


def _filled(rows: DataFrame, keys: Sequence[str], what: str, listed: Column) -> DataFrame:
    """A row for each value in the array ``listed`` per ``keys``, with 0 cancellations where absent; others are left out.

    ``rows`` is aggregated, so each group folds into a map no longer than what is printed in a row.
    """
    cells = F.map_from_entries(F.collect_list(F.when(F.array_contains(listed, F.col(what)), F.struct(what, "cancellations"))))
    count = F.coalesce(F.try_element_at("_cells", what), F.lit(0))
    return (
        rows.groupBy(*keys)
        .agg(cells.alias("_cells"))
        .withColumn(what, F.explode(listed))
        .select(*keys, what, count.alias("cancellations"))
    )


def cancel_by_reason_segment(base: DataFrame, segments: Mapping[str, int], blank_is_missing: bool = False) -> DataFrame:
    """Cancellations and subscriptions per reason and segment, with column shares.

    ``base``: cancel_id, subscription_id, reason, segment_code.
    """
    counts = [F.count_if(F.col("segment_code") == code).alias(name) for name, code in segments.items()]
    table = base.groupBy(reason_root(F.col("reason"), blank_is_missing=blank_is_missing).alias("reason")).agg(
        F.count("cancel_id").alias("cancellations"), F.countDistinct("subscription_id").alias("subscriptions"), *counts
    )
    return _with_shares(table, ["cancellations", *segments])


def cancel_by_reason_experience(base: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Cancellations and subscriptions per reason and experience, with column shares.

    ``labels`` maps a column name to the experience label it counts.
    """
    experience = F.coalesce("experience", F.lit("Unknown"))
    counts = [F.count_if(experience == label).alias(name) for name, label in labels.items()]
    table = base.groupBy(reason_root(F.col("reason")).alias("reason")).agg(
        F.count("cancel_id").alias("cancellations"), F.countDistinct("subscription_id").alias("subscriptions"), *counts
    )
    return _with_shares(table, ["cancellations", *labels])


def _by_reason_item(rows: DataFrame, listed_items: Sequence, segments: Mapping[str, int]) -> DataFrame:
    """``rows``: one per cancellation, with reason, segment_code and item_ids."""
    own = [F.when(F.col("segment_code") == code, F.lit(name)) for name, code in segments.items()]
    split = rows.withColumn("segment", F.explode(F.array_compact(F.array(F.lit("all"), *own))))
    item_type = rows.schema["item_ids"].dataType.elementType
    counts = (
        split.select("segment", "reason", F.explode("item_ids").alias("item_id"))
        .groupBy("segment", "reason", "item_id")
        .agg(F.count(F.lit(1)).alias("cancellations"))
    )
    listed = F.array(*[F.lit(i).cast(item_type) for i in listed_items])
    matrix = _filled(counts, ["segment", "reason"], "item_id", listed)
    # One row per reason in each window.
    total = F.sum("cancellations").over(W.partitionBy("segment", "item_id"))
    return matrix.withColumn("share_pct", F.round(percent(F.col("cancellations"), total), 2))


def cancel_by_reason_item(base: DataFrame, listed_items: Sequence, segments: Mapping[str, int]) -> DataFrame:
    """Reason x item counts with the share of the item's total, for everyone and per segment, in long form."""
    rows = base.select(reason_root(F.col("reason")).alias("reason"), "segment_code", F.col("listed_items").alias("item_ids"))
    return _by_reason_item(rows, listed_items, segments)


def cancel_by_reason_last_item(item_rows: DataFrame, listed_items: Sequence, segments: Mapping[str, int]) -> DataFrame:
    """The same from ``cancel_by_last_order``: an item counts once per (subscription, moment)."""
    rows = (
        item_rows.filter(F.col("item_id").isin(list(listed_items)))
        .groupBy("subscription_id", "cancelled_at")
        .agg(
            F.min(reason_root(F.col("reason"), blank_is_missing=True)).alias("reason"),
            F.min("segment_code").alias("segment_code"),
            F.collect_set("item_id").alias("item_ids"),
        )
    )
    return _by_reason_item(rows.select("reason", "segment_code", "item_ids"), listed_items, segments)


def active_distribution(
    subscriptions: DataFrame,
    orders: DataFrame,
    subscription_items: DataFrame,
    start: str,
    end: str,
    listed_items: Sequence,
    segments: Mapping[str, int],
    experience: Labels,
    experience_variables: Sequence[int],
) -> DataFrame:
    """Subscriptions with an order in ``[start, end]`` by segment, item and experience, with shares.

    A subscription with several listed items counts under the lowest id.
    """
    ordered = (
        counted_orders(orders)
        .filter(in_period(F.col("created_at"), start, end, "[]"))
        .select(F.col("subscription_id").alias("id"))
        .distinct()
    )
    item = (
        subscription_items.filter(F.col("itemId").isin(list(listed_items)))
        .groupBy(F.col("subscriptionId").alias("id"))
        .agg(F.min("itemId").alias("item_id"))
    )
    rows = (
        subscriptions.select("id", _diagnostic().alias("text"))
        .join(item, "id")
        .join(ordered, "id", "left_semi")
        .withColumn("answers", parsed(F.col("text")))
        .select(
            F.col("item_id").cast("string").alias("item"),
            first_code(F.col("answers"), list(segments.values())).alias("code"),
            labelled(answer_to(F.col("answers"), experience_variables), experience).alias("experience"),
        )
    )
    segment = F.lit("none")
    for name, code in segments.items():
        segment = F.when(F.col("code") == code, F.lit(name)).otherwise(segment)
    cells = F.array(
        F.struct(F.lit("segment").alias("dimension"), segment.alias("label")),
        F.struct(F.lit("item").alias("dimension"), F.col("item").alias("label")),
        F.struct(F.lit("experience").alias("dimension"), F.col("experience").alias("label")),
    )
    counts = rows.select(F.inline(cells)).groupBy("dimension", "label").agg(F.count(F.lit(1)).alias("subscriptions"))
    listed = (
        [("segment", n) for n in (*segments, "none")]
        + [("item", str(i)) for i in listed_items]
        + [("experience", e) for e in (*experience, "Unknown")]
    )
    columns = {"dimension": [d for d, _ in listed], "label": [n for _, n in listed]}
    spine = small_table(subscriptions.sparkSession, columns, "dimension string, label string")
    table = (
        spine.unionByName(counts, allowMissingColumns=True)
        .groupBy("dimension", "label")
        .agg(F.coalesce(F.sum("subscriptions"), F.lit(0)).alias("subscriptions"))
    )
    # At most one row per listed label, so the window is small.
    total = F.sum("subscriptions").over(W.partitionBy("dimension"))
    return table.withColumn("share_pct", F.round(percent(F.col("subscriptions"), total), 2))


# --- calendars ----------------------------------------------------------------


def cancel_item_rows(
    cancellations: DataFrame, subscriptions_view: DataFrame, subscription_items: DataFrame, products: DataFrame
) -> DataFrame:
    """Cancellations of cancelled subscriptions per day and product.

    ``products``: itemId, product. Items are folded per subscription before the
    join, so a subscription's cancellations never meet all its items row by row.
    """
    per_subscription = (
        subscription_items.join(products.select("itemId", "product"), "itemId")
        .groupBy(F.col("subscriptionId").alias("subscription_id"), "product")
        .agg(F.count(F.lit(1)).alias("_items"))
    )
    cancelled = subscriptions_view.filter(F.col("status") == "CANCELLED").select("subscription_id")
    per_day = cancellations.groupBy(
        F.col("subscriptionId").alias("subscription_id"), day_of(F.col("createdAt")).alias("day")
    ).agg(F.count(F.lit(1)).alias("_cancellations"))
    return (
        per_day.join(cancelled, "subscription_id")
        .join(per_subscription, "subscription_id")
        .groupBy("day", "product")
        .agg(F.sum(F.col("_items") * F.col("_cancellations")).alias("cancellations"))
    )


def _literals(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def cancel_item_daily(rows: DataFrame, products: Sequence[str]) -> DataFrame:
    """Counts per day and listed product, a total row, and each product's share of all cancellations of listed ones."""
    daily = _filled(rows, ["day"], "product", _literals(products))
    labels = F.explode(F.array(F.lit("day"), F.lit("total")))
    table = (
        daily.withColumn("row_type", labels)
        .withColumn("label", F.when(F.col("row_type") == "day", F.date_format("day", "yyyy-MM-dd")).otherwise(F.lit("Total")))
        .groupBy("row_type", "label", "product")
        .agg(F.sum("cancellations").alias("cancellations"))
    )
    # One row per product in each window.
    everything = F.sum("cancellations").over(W.partitionBy("row_type", "label"))
    share = F.when(F.col("row_type") == "total", safe_ratio(F.col("cancellations"), everything))
    return table.withColumn("historic_share", share)


def cancel_item_monthly(rows: DataFrame, products: Sequence[str], tolerance: float = 0.4) -> DataFrame:
    """Counts and shares per month and listed product with a total per year, flagged where far off the overall share."""
    monthly = (
        rows.withColumn("month", month_of(F.col("day")))
        .groupBy("month", "product")
        .agg(F.sum("cancellations").alias("cancellations"))
    )
    # Windows over months x products: a bounded, already aggregated table.
    of_product = F.sum("cancellations").over(W.partitionBy("product"))
    everything = F.sum("cancellations").over(W.partitionBy())
    filled = (
        _filled(monthly, ["month"], "product", _literals(products))
        .withColumn("year", F.year("month"))
        .withColumn("historic_share", safe_ratio(of_product, everything))
    )
    leveled = filled.withColumn("row_type", F.explode(F.array(F.lit("month"), F.lit("total"))))
    table = (
        leveled.withColumn("month", F.when(F.col("row_type") == "month", F.month("month")))
        .groupBy("year", "row_type", "month", "product")
        .agg(F.sum("cancellations").alias("cancellations"), F.first("historic_share").alias("historic_share"))
    )
    row_total = F.sum("cancellations").over(W.partitionBy("year", "row_type", "month"))
    share, historic = F.col("share"), F.col("historic_share")
    return table.withColumn("share", safe_ratio(F.col("cancellations"), row_total)).select(
        "year",
        "row_type",
        "month",
        "product",
        "cancellations",
        "share",
        "historic_share",
        deviation_flag(F.when(historic > 0, share / historic - 1), tolerance).alias("flag"),
    )


def cancel_reason_calendar(
    cancellations: DataFrame,
    subscription_items: DataFrame,
    start: str,
    end: str,
    include_items: Sequence | None = None,
    exclude_items: Sequence | None = None,
    tolerance: float = 0.4,
) -> DataFrame:
    """Reason x month counts and shares per year of ``(start, end)``, with yearly totals and mean shares.

    A cancellation counts once per matching subscription item. Months are
    flagged where a reason's share is far off its share over all years.
    """
    items = subscription_items
    if include_items is not None:
        items = items.filter(F.col("itemId").isin(list(include_items)))
    if exclude_items is not None:
        items = items.filter(~F.col("itemId").isin(list(exclude_items)))
    per_subscription = items.groupBy("subscriptionId").agg(F.count(F.lit(1)).alias("_items"))
    monthly = (
        cancellations.filter(in_period(F.col("createdAt"), start, end, "()"))
        .groupBy("subscriptionId", reason_root(F.col("reason"), "-").alias("reason"), month_of(F.col("createdAt")).alias("date"))
        .agg(F.count(F.lit(1)).alias("_cancellations"))
        .join(per_subscription, "subscriptionId")
        .groupBy("reason", F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(F.sum(F.col("_items") * F.col("_cancellations")).alias("cancellations"))
    )
    # A year's table lists the reasons of that year for each of its months. From here on all
    # windows run over years x months x reasons.
    filled = _filled(
        monthly.withColumn("_months", F.array_sort(F.collect_set("month").over(W.partitionBy("year")))),
        ["year", "reason", "_months"],
        "month",
        F.col("_months"),
    ).drop("_months")
    month_total = F.sum("cancellations").over(W.partitionBy("year", "month"))
    of_reason, everything = F.sum("cancellations").over(W.partitionBy("reason")), F.sum("cancellations").over(W.partitionBy())
    shared = filled.withColumn("share", safe_ratio(F.col("cancellations"), month_total)).withColumn(
        "historic_share", safe_ratio(of_reason, everything)
    )
    kinds = F.explode(F.array(F.lit("month"), F.lit("total"), F.lit("mean")))
    kind = F.col("row_type")
    table = (
        shared.withColumn("row_type", kinds)
        .withColumn("month", F.when(kind == "month", F.col("month")))
        .groupBy("year", "row_type", "month", "reason")
        .agg(
            F.sum("cancellations").alias("cancellations"),
            F.avg("share").alias("share"),
            F.first("historic_share").alias("historic_share"),
        )
    )
    historic = F.col("historic_share")
    return table.select(
        "year",
        "row_type",
        "month",
        "reason",
        F.when(kind != "mean", F.col("cancellations")).alias("cancellations"),
        F.when(kind != "total", F.col("share")).alias("share"),
        historic,
        F.when(kind == "month", deviation_flag(deviation(F.col("share"), historic), tolerance)).alias("flag"),
    )
