"""Repurchase by product, by bundle, and by questionnaire answer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.functions.answers import answer_list, parsed
from shopledger.functions.periods import in_period
from shopledger.functions.scalars import percent
from shopledger.operators.core import metric_rows, small_table
from shopledger.operators.orders import counted_orders


def product_purchases(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    start: str,
    end: str,
    category: str,
    plan: str = "OTO",
) -> DataFrame:
    """Distinct (customer, order, product) of first-time buyers of the period.

    Orders count at any time if they hold the category; buyers qualify by a
    first order inside ``[start, end]``. ``products``: itemId, product_name.
    """
    sold = orders.filter((F.col("status") != "CANCELLED") & (F.col("order_plan") == plan) & (F.col("recurrent") == 0))
    # Lines are folded per order: whether it holds the category, and its product names.
    named = items.join(products.select("itemId", "product_name"), "itemId", "left")
    per_order = named.groupBy(F.col("salesOrderId").alias("id")).agg(
        F.max(F.col("category") == category).alias("_in_category"), F.collect_set("product_name").alias("names")
    )
    sold = sold.join(per_order, "id")
    first = (F.col("is_first_order") == 1) & in_period(F.col("created_at"), start, end, "[]")
    buyers = sold.filter(first).select("customer_id").distinct()
    return (
        sold.filter("_in_category")
        .join(buyers, "customer_id", "left_semi")
        .select("customer_id", "id", F.explode("names").alias("product_name"))
    )


def _repurchase_table(purchases: DataFrame, what: str) -> DataFrame:
    """Users, repeat users and orders per ``what`` from distinct (customer, order, what)."""
    per_user = purchases.groupBy(what, "customer_id").agg(F.count(F.lit(1)).alias("orders"))
    return (
        per_user.groupBy(what)
        .agg(
            F.count_if(F.col("orders") > 1).alias("repurchasers"),
            F.count(F.lit(1)).alias("users"),
            F.sum("orders").alias("orders"),
        )
        .withColumn("repurchase_pct", F.round(percent(F.col("repurchasers"), F.col("users")), 2))
    )


def product_repurchase(purchases: DataFrame) -> DataFrame:
    """Per product: users, users with it in more than one order, orders with it."""
    return _repurchase_table(purchases, "product_name")


def sample_size(purchases: DataFrame) -> DataFrame:
    """How many customers ``product_purchases`` looks at."""
    return metric_rows(purchases.agg(F.count_distinct("customer_id").alias("n")), {"customers": F.col("n")})


def combinations(spark: SparkSession, named: Mapping[str, Sequence], columns: Sequence[str]) -> DataFrame:
    """A small dimension of (combination, wanted..., size) from caller-given lists."""
    rows = []
    for name, wanted in named.items():
        distinct = list(dict.fromkeys(tuple(w) if isinstance(w, (tuple, list)) else (w,) for w in wanted))
        rows += [(name, *w, len(distinct)) for w in distinct]
    names = ["combination", *columns, "size"]
    schema = ", ".join(f"{c} {'int' if c == 'size' else 'string'}" for c in names)
    return small_table(spark, {c: [r[i] for r in rows] for i, c in enumerate(names)}, schema)


def product_bits(products: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """``itemId, bits``: the wanted products that an item counts as, bit ``i % 63`` of word ``i // 63`` for product ``i``."""
    places = {name: i for i, name in enumerate(wanted)}
    words = [[n for n, i in places.items() if i // 63 == w] for w in range(-(-len(places) // 63))]

    def word(names: Sequence[str]) -> Column:
        bits = F.lit(0).cast("long")
        for name in names:
            bits = F.when(F.col("product_name") == name, F.lit(1 << places[name] % 63)).otherwise(bits)
        return bits

    listed = products.filter(F.col("product_name").isin(list(wanted)))
    return listed.groupBy("itemId").agg(*[F.bit_or(word(names)).alias(f"bits_{w}") for w, names in enumerate(words)])


def bundle_repurchase(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    start: str,
    end: str,
    category: str,
    bundles: Sequence[Sequence[str]],
    plan: str = "OTO",
) -> DataFrame:
    """Per bundle: users, users with it in more than one order, and orders, of those that hold *all* its products.

    Buyers, orders and the category are those of ``product_purchases``; bundles nobody bought are left
    out. An order is a few words of bits, a customer a few counts: orders and lines are read once.
    """
    named = {" + ".join(sorted(b)): b for b in bundles}
    wanted = list(dict.fromkeys(p for b in named.values() for p in b))
    bits = product_bits(products, wanted)
    words = [c for c in bits.columns if c != "itemId"]
    per_order = (
        items.join(bits, "itemId", "left")
        .groupBy(F.col("salesOrderId").alias("id"))
        .agg(F.max(F.col("category") == category).alias("_in_category"), *[F.bit_or(w).alias(w) for w in words])
    )

    def holds(bundle: Sequence[str]) -> Column:
        masks = [0] * len(words)
        for product in bundle:
            place = wanted.index(product)
            masks[place // 63] |= 1 << place % 63
        whole = F.col("_in_category")
        for w, mask in zip(words, masks, strict=True):
            if mask:
                whole &= F.col(w).bitwiseAND(F.lit(mask)) == mask
        return whole

    sold = orders.filter(
        (F.col("status") != "CANCELLED")
        & (F.col("order_plan") == plan)
        & (F.col("recurrent") == 0)
        & F.col("customer_id").isNotNull()
    )
    first = (F.col("is_first_order") == 1) & in_period(F.col("created_at"), start, end, "[]")
    counts = [f"_n{i}" for i in range(len(named))]
    per_user = (
        sold.select("id", "customer_id", first.alias("_first"))
        .join(per_order, "id")
        .groupBy("customer_id")
        .agg(F.max("_first").alias("_buyer"), *[F.count_if(holds(b)).alias(n) for n, b in zip(counts, named.values(), strict=True)])
        .filter("_buyer")
    )
    users = [F.struct(F.lit(name).alias("combination"), F.col(n).alias("orders")) for n, name in zip(counts, named, strict=True)]
    return (
        per_user.select(F.inline(F.array(*users)))
        .filter("orders > 0")
        .groupBy("combination")
        .agg(
            F.count_if(F.col("orders") > 1).alias("repurchasers"),
            F.count(F.lit(1)).alias("users"),
            F.sum("orders").alias("orders"),
        )
        .withColumn("repurchase_pct", F.round(percent(F.col("repurchasers"), F.col("users")), 2))
    )


def first_order_cohort(
    orders: DataFrame,
    items: DataFrame,
    raw_items: DataFrame,
    start: str,
    end: str,
    horizon: str,
    category: str,
    custom_categories: Sequence[str],
    kit_items: Sequence,
    plan: str | None = None,
    tracked_items: Sequence = (),
) -> DataFrame:
    """First orders of the period with a category: questionnaire, tracked items, custom orders up to the horizon.

    The questionnaire is that of the kit line with the lowest item id.
    """
    cohorts = first_order_cohorts(
        orders, items, raw_items, {"": (start, end)}, horizon, category, custom_categories, kit_items, plan, tracked_items
    )
    return cohorts.drop("period")


def first_order_cohorts(
    orders: DataFrame,
    items: DataFrame,
    raw_items: DataFrame,
    periods: Mapping[str, tuple[str, str]],
    horizon: str,
    category: str,
    custom_categories: Sequence[str],
    kit_items: Sequence,
    plan: str | None = None,
    tracked_items: Sequence = (),
) -> DataFrame:
    """``first_order_cohort`` of each of the named ``(start, end)`` periods, told apart by ``period``, in one pass.

    Periods may overlap: a first order is in each one that it falls in, and its customer's custom
    orders count from that one's start. Tables are read as often as for a single period.
    """
    valid = counted_orders(orders)
    named = list(periods)
    earliest, latest = min(s for s, _ in periods.values()), max(e for _, e in periods.values())

    def falling(last: Mapping[str, str]) -> Column:
        """The names of the periods from whose start up to ``last`` a row lies."""
        return F.array_compact(
            F.array(*[F.when(in_period(F.col("created_at"), periods[n][0], last[n], "[]"), F.lit(n)) for n in named])
        )

    lines = items.select(F.col("salesOrderId").alias("id"), "itemId", "category")
    first = valid.filter((F.col("is_first_order") == 1) & in_period(F.col("created_at"), earliest, latest, "[]"))
    if plan is not None:
        first = first.filter(F.col("order_plan") == plan)
    # One pass over the lines answers all per-order questions.
    is_custom = F.col("category").isin(list(custom_categories))
    tracked = F.when(F.col("itemId").isin(list(tracked_items)), F.col("itemId")) if tracked_items else F.lit(None)
    per_order = lines.groupBy("id").agg(
        F.max(F.col("category") == category).alias("_has_category"),
        F.max(is_custom).alias("_is_custom"),
        F.collect_set(tracked.cast("string")).alias("tracked_items"),
    )
    custom = (
        valid.filter(in_period(F.col("created_at"), earliest, horizon, "[]"))
        .join(per_order.filter("_is_custom").select("id"), "id", "left_semi")
        .select("customer_id", F.explode(falling(dict.fromkeys(named, horizon))).alias("period"))
        .groupBy("customer_id", "period")
        .agg(F.count(F.lit(1)).alias("total_custom_orders"))
    )
    kit = (
        raw_items.filter(F.col("itemId").isin(list(kit_items)))
        .groupBy(F.col("salesOrderId").alias("id"))
        .agg(
            F.min(F.struct("itemId", F.get_json_object("additionalFields", "$.diagnostic").alias("diagnostic")))[
                "diagnostic"
            ].alias("diagnostic")
        )
    )
    return (
        first.select("id", "customer_id", "created_at")
        .join(per_order.filter("_has_category").select("id", "tracked_items"), "id")
        .join(kit, "id", "left")
        .withColumn("period", F.explode(falling({n: e for n, (_, e) in periods.items()})))
        .join(custom, ["customer_id", "period"])
        .select(
            "period",
            F.col("id").alias("order_id"),
            "customer_id",
            "diagnostic",
            "total_custom_orders",
            "tracked_items",
            F.col("created_at").alias("first_order_date"),
        )
    )


def labelled_answers(
    cohort: DataFrame, variable_labels: Mapping[int, str], value_labels: Mapping[int, str]
) -> DataFrame:
    """One row per answer: cohort columns plus variable number, variable label and value label.

    Unknown codes keep a label made of the code itself.
    """
    spark = cohort.sparkSession
    variables = small_table(
        spark,
        {"variable": list(variable_labels), "variable_label": list(variable_labels.values())},
        "variable int, variable_label string",
    )
    values = small_table(
        spark,
        {"value_code": list(value_labels), "value_label": list(value_labels.values())},
        "value_code int, value_label string",
    )
    known = cohort.filter(F.col("diagnostic").isNotNull()).withColumn("_answers", parsed(F.col("diagnostic")))
    answers = known.select(*[c for c in cohort.columns if c != "diagnostic"], F.inline(answer_list(F.col("_answers"))))
    return (
        answers.withColumn("value_code", F.trim("value").try_cast("int"))
        .join(variables, "variable", "left")
        .join(values, "value_code", "left")
        .withColumn(
            "variable_label",
            F.coalesce("variable_label", F.concat(F.lit("VARIABLE_"), F.col("variable").cast("string"))),
        )
        .withColumn("value_label", F.coalesce("value_label", "value"))
        .drop("value", "value_code")
    )


def _by_outcome(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    again = F.col("total_custom_orders") > 1
    return (
        rows.groupBy(*keys)
        .agg(
            F.count_if(again).alias("repurchased"),
            F.count_if(~again).alias("not_repurchased"),
            F.count(F.lit(1)).alias("total"),
        )
        .withColumn("repurchase_pct", percent(F.col("repurchased"), F.col("total")))
    )


def repurchase_by_answer(
    answers: DataFrame, skipped_variables: Sequence[int], tracked_item: str | None = None
) -> DataFrame:
    """Per translated answer: who bought again. Codes with one label count together.

    ``answers`` comes from ``labelled_answers``; ``tracked_item`` keeps only
    first orders holding that item.
    """
    rows = answers.filter(~F.col("variable").isin(list(skipped_variables)))
    if tracked_item is not None:
        rows = rows.filter(F.array_contains("tracked_items", tracked_item))
    return _by_outcome(rows, [F.col("variable_label").alias("variable"), F.col("value_label").alias("value")])


def repurchase_by_answer_variants(answers: DataFrame, skipped_variables: Sequence[int], tracked_items: Sequence[str]) -> DataFrame:
    """The same for all first orders (``item`` = all) and for those holding each of ``tracked_items``, in one pass."""
    wanted = F.array(*[F.lit(str(i)) for i in tracked_items])
    items = F.concat(F.array(F.lit("all")), F.array_intersect(wanted, F.col("tracked_items").cast("array<string>")))
    rows = answers.filter(~F.col("variable").isin(list(skipped_variables))).withColumn("item", F.explode(items))
    return _by_outcome(rows, ["item", F.col("variable_label").alias("variable"), F.col("value_label").alias("value")])


def repurchase_by_answer_periods(answers: DataFrame, skipped_variables: Sequence[int]) -> DataFrame:
    """The same for each ``period`` of ``first_order_cohorts``, in one pass."""
    rows = answers.filter(~F.col("variable").isin(list(skipped_variables)))
    return _by_outcome(rows, ["period", F.col("variable_label").alias("variable"), F.col("value_label").alias("value")])


def repurchase_by_combination(answers: DataFrame, wanted: Mapping[str, Sequence[tuple[str, str]]]) -> DataFrame:
    """Per named set of (variable label, value label): first orders giving all of them, and who bought again."""
    named = combinations(answers.sparkSession, wanted, ["variable_label", "value_label"])
    complete = (
        answers.select("order_id", "total_custom_orders", "variable_label", "value_label")
        .join(named, ["variable_label", "value_label"])
        .select("combination", "size", "order_id", "total_custom_orders", "variable_label", "value_label")
        .distinct()
        .groupBy("combination", "size", "order_id", "total_custom_orders")
        .agg(F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == F.col("size"))
    )
    return _by_outcome(complete, ["combination"])


def repurchase_period_table(tables: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Several periods side by side in long form, with shares; a row missing from a period counts 0.

    ``tables``: period, variable, value and the columns of ``repurchase_by_answer``.
    Adds the share of the period's largest total and of the variable's total.
    """
    keys = ["variable", "value"]
    counts = ["repurchased", "not_repurchased", "total"]
    # One row per answer with a cell per period, then back to rows: absent cells become 0.
    cells = [
        F.struct(
            F.lit(p).alias("period"),
            *[F.coalesce(F.sum(F.when(F.col("period") == p, F.col(c))), F.lit(0)).alias(c) for c in counts],
        )
        for p in periods
    ]
    filled = tables.groupBy(*keys).agg(F.array(*cells).alias("cells")).select(*keys, F.inline("cells"))
    # The table has one row per answer and period: the questionnaire's length.
    largest = F.max("total").over(W.partitionBy("period"))
    of_variable = F.sum("total").over(W.partitionBy("period", "variable"))
    return filled.select(
        "period",
        *keys,
        *counts,
        percent(F.col("total"), largest).alias("pct_of_max"),
        percent(F.col("total"), of_variable).alias("pct_of_variable"),
        percent(F.col("repurchased"), F.col("total")).alias("repurchase_pct"),
    )
