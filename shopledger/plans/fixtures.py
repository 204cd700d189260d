"""The logical tables of the reports, derived from a star schema of orders and events.

Each builder takes the catalog and returns one table. Nothing is cut away:
variety (statuses, plans, missing values) is written into the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.sources.catalog import Catalog

MONEY = "decimal(18,2)"

ITEM_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _plan() -> Column:
    level = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(level.isin("1", "2"), F.lit("SUBSCRIPTION")).when(level == "3", F.lit("MIXED")).otherwise(F.lit("OTO"))
    )


def _answers(cust: str, nation: str, balance: str) -> str:
    """SQL for questionnaire JSON: a list for even customers, an object for odd ones, sometimes no JSON."""
    given = [
        ("'4'", f"13 + {cust} % 3"),
        (
            f"if({nation} % 5 = 0, '36', '40')",
            f"if({nation} % 5 = 0, element_at(array(112, 116, 114), {nation} % 3 + 1), 118 + {nation} % 3)",
        ),
        ("'41'", f"if({balance} < 0, 121, 122)"),
        ("'27'", f"1000 + {cust}"),
    ]
    as_list = ", ',', ".join(f"""'{{"variable":', {v}, ',"value":', {a}, '}}'""" for v, a in given)
    as_object = ", ',', ".join(
        f"""'"{900 + i}":{{"value":"', {a}, '","variable":"', {v}, '"}}'""" for i, (v, a) in enumerate(given)
    )
    return f"""CASE WHEN {cust} % 97 = 0 THEN '"not json"'
        WHEN {cust} % 2 = 0 THEN concat('{{"values":[', {as_list}, ']}}')
        ELSE concat('{{"values":{{', {as_object}, '}}}}') END"""


def _program(nation: str) -> str:
    """SQL for the program flag as a JSON member, absent for every third nation."""
    return f"""CASE {nation} % 3 WHEN 0 THEN ',"sms_renewal":"true"' WHEN 1 THEN ',"sms_renewal":"false"' ELSE '' END"""


def orders_light(c: Catalog) -> DataFrame:
    """Orders without units and first-order flag, for reports that use neither."""
    return c.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("ON"), F.col("o_orderkey")).alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_custkey").alias("subscription_id"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "P", F.lit("CANCELLED")).otherwise(F.lit("PAID")).alias("status"),
        _plan().alias("order_plan"),
        F.col("o_totalprice").cast(MONEY).alias("total"),
    )


def orders_flagged(c: Catalog) -> DataFrame:
    """Orders with the first-order flag. Joined by order id, so no customer is too busy."""
    orders = orders_light(c)
    first = (
        orders.groupBy("customer_id")
        .agg(F.min(F.struct("created_at", "id"))["id"].alias("id"))
        .select("id", F.lit(1).alias("is_first_order"))
    )
    return orders.join(first, "id", "left").withColumns(
        {
            "is_first_order": F.coalesce("is_first_order", F.lit(0)),
            "recurrent": F.when(
                (F.col("order_plan") == "SUBSCRIPTION") & F.col("is_first_order").isNull(), F.lit(1)
            ).otherwise(F.lit(0)),
        }
    )


def fact_orders(c: Catalog) -> DataFrame:
    units = (
        c.table("lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.sum(F.col("l_quantity").cast("int")).cast("int").alias("units"))
    )
    return c.table("orders_flagged").join(units, "id", "left")


def _item() -> Column:
    """The shop's item of a part: one for each brand and type, so that item lists weigh the same at every size."""
    kind = F.array_position(F.array(*[F.lit(t) for t in ITEM_TYPES]), F.col("p_type")) - 1
    return F.substring_index("p_brand", "#", -1).cast("bigint") * 10 + kind


def item_lines(c: Catalog) -> DataFrame:
    parts = c.table("part").select(F.col("p_partkey").alias("l_partkey"), _item().alias("itemId"), F.col("p_type").alias("category"))
    return c.table("lineitem").join(parts, "l_partkey")


def order_items(c: Catalog) -> DataFrame:
    """Order lines without category."""
    return item_lines(c).select(
        F.col("l_orderkey").alias("salesOrderId"), "itemId", F.col("l_quantity").cast("int").alias("quantity")
    )


def fact_order_items(c: Catalog) -> DataFrame:
    return item_lines(c).select(
        "itemId", F.col("l_orderkey").alias("salesOrderId"), F.col("l_quantity").cast("int").alias("quantity"), "category"
    )


def customer_facts(c: Catalog) -> DataFrame:
    return c.table("customer").select(
        F.col("c_custkey").alias("cust"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    )


def sales_orders(c: Catalog) -> DataFrame:
    people = customer_facts(c)
    fields = F.expr(f"""concat('{{"diagnostic":', {_answers("cust", "nation", "balance")}, {_program("nation")}, '}}')""")
    return (
        c.table("orders")
        .select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"), F.col("o_orderdate").alias("createdAt"))
        .join(people, "cust")
        .select("id", F.col("cust").alias("customerId"), "createdAt", fields.alias("additionalFields"))
    )


def order_items_raw(c: Catalog) -> DataFrame:
    """Order lines with the questionnaire on the first line of an order."""
    lines = item_lines(c).select(F.col("l_orderkey").alias("id"), "itemId", "l_linenumber")
    whole = sales_orders(c).select("id", "additionalFields")
    return lines.join(whole, "id").select(
        F.col("id").alias("salesOrderId"),
        "itemId",
        F.when(F.col("l_linenumber") == 1, F.col("additionalFields")).alias("additionalFields"),
    )


def cancellations(c: Catalog) -> DataFrame:
    return (
        c.table("orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("subscriptionId"),
            F.concat_ws(" -> ", "o_orderpriority", "o_orderstatus").alias("reason"),
            F.col("o_orderdate").alias("createdAt"),
        )
    )


def _status(cust: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(s) for s in ("CANCELLED", "ACTIVE", "PROCESSING", "ON_HOLD")]), (cust % 4 + 1).cast("int")
    )


def subscriptions(c: Catalog) -> DataFrame:
    dates = (
        c.table("orders")
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(F.min("o_orderdate").alias("createdAt"), F.max("o_orderdate").alias("updatedAt"))
    )
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    fields = F.expr(
        f"""concat('{{"frequency":"Every ', 1 + c_custkey % 8, ' weeks","snooze":"', if(c_acctbal < 0, '1', '0'),
        '","diagnostic":', {_answers("c_custkey", "c_nationkey", "c_acctbal")}, {_program("c_nationkey")}, '}}')"""
    )
    people = c.table("customer").select(
        key.alias("id"),
        key.alias("customerId"),
        F.col("c_mktsegment").alias("plan_id"),
        _status(key).alias("status"),
        F.when(nation % 3 == 0, F.lit(1)).otherwise(F.lit(0)).alias("sms_renewal"),
        fields.alias("additionalFields"),
    )
    return people.join(dates, "id", "left").withColumn("created_at", F.col("createdAt"))


def subscriptions_view(c: Catalog) -> DataFrame:
    key = F.col("c_custkey")
    return c.table("customer").select(
        key.alias("subscription_id"),
        F.when(key % 2 == 0, F.lit("CAT_A")).otherwise(F.lit("CAT_B")).alias("legacy_category"),
        F.concat(7 * (1 + key % 8), F.lit(" days")).alias("delivery_frequency"),
        _status(key).alias("status"),
    )


def subscription_items(c: Catalog) -> DataFrame:
    """Each subscription order's lines as items of the customer's subscription."""
    owners = (
        c.table("orders")
        .filter(_plan() == "SUBSCRIPTION")
        .select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("subscriptionId"))
    )
    return (
        item_lines(c)
        .join(owners, "l_orderkey")
        .select(
            "subscriptionId",
            "itemId",
            F.when(F.col("l_quantity") > 25, F.lit(-1)).otherwise(F.lit(1)).alias("timesRemaining"),
        )
    )


def items_item_groups(c: Catalog) -> DataFrame:
    item = _item().alias("itemId")
    return c.table("part").select(item).distinct().select(
        "itemId", F.concat(F.lit("G"), (F.col("itemId") / 10).cast("int") % 5).alias("itemGroupId")
    )


def products(c: Catalog) -> DataFrame:
    """Product names; several items share one name."""
    return c.table("part").select(
        _item().alias("itemId"), F.col("p_brand").alias("product_name"), F.col("p_type").alias("product")
    ).distinct()


def customers(c: Catalog) -> DataFrame:
    email = F.concat(F.lit("user"), F.col("c_custkey"), F.lit("@example.com"))
    return c.table("customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") < 13, email).alias("email")
    )


def program_enrollments(c: Catalog) -> DataFrame:
    per_customer = (
        c.table("orders")
        .filter(_plan() == "SUBSCRIPTION")
        .groupBy(F.col("o_custkey").alias("subscription_id"))
        .agg(F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("_last"))
    )
    return per_customer.select(
        "subscription_id", "first_date", F.when(F.col("subscription_id") % 3 != 0, F.col("_last")).alias("last_date")
    )


def renewals(c: Catalog) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "P", F.lit("FAILED"))
        .when(F.col("o_custkey") % 7 == 0, F.lit("PENDING"))
        .otherwise(F.lit("SUCCESS"))
    )
    return c.table("orders").select(
        F.concat(F.lit("RE"), F.col("o_orderkey")).alias("id"),
        F.col("o_custkey").alias("subscriptionId"),
        F.col("o_orderdate").alias("createdAt"),
        status.alias("status"),
    )


def fees(c: Catalog) -> DataFrame:
    level = F.substring("o_orderpriority", 1, 1)
    every = F.when(level == "5", F.lit("Every 2 months")).otherwise(F.concat(F.lit("Every "), level, F.lit(" weeks")))
    return c.table("orders").select(
        F.concat(F.lit("RE"), F.col("o_orderkey")).alias("entityId"),
        F.concat(F.lit("Subscription ("), every, F.lit(")")).alias("description"),
        F.col("o_orderdate").alias("createdAt"),
    )


def renewal_payments(c: Catalog) -> DataFrame:
    """Attempts to charge a renewal: one per order line, an hour apart."""
    dates = c.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    hours = F.make_dt_interval(F.lit(0), F.col("l_linenumber") - 1)
    return (
        c.table("lineitem")
        .select("l_orderkey", "l_linenumber")
        .join(dates, "l_orderkey")
        .select(
            F.concat(F.lit("RE"), F.col("l_orderkey")).alias("entityId"),
            (F.col("o_orderdate") + hours).alias("createdAt"),
        )
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _entity() -> Column:
    return F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))


def payments(c: Catalog) -> DataFrame:
    k = _k()
    coded = F.concat(
        F.lit('{"isBackupPayment":'),
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"stripeError":{"error":{"decline_code":"code_'),
        k % 10,
        F.lit('"}}}'),
    )
    return (
        c.table("events")
        .filter(F.col("event_type").isin("error", "purchase"))
        .select(
            F.col("event_id").alias("id"),
            _entity().alias("entityId"),
            F.col("user_id").alias("customerId"),
            F.col("ts").alias("createdAt"),
            F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
            F.when(k % 10 == 8, F.lit("not json")).when(k % 10 == 9, F.lit("{}")).otherwise(coded).alias("metadata"),
        )
    )


def payment_attempts(c: Catalog) -> DataFrame:
    return (
        c.table("events")
        .filter(F.col("event_type").isin("error", "purchase"))
        .select(
            F.date_format("ts", "yyyyMMdd").alias("description"),
            F.concat(F.lit("user"), F.col("user_id"), F.lit("@example.com")).alias("customer_email"),
            F.when(F.col("event_type") == "error", F.lit("Failed")).otherwise(F.lit(" Paid")).alias("status"),
            F.col("ts").alias("created_utc"),
            F.concat(F.lit("card"), _k() % 3).alias("card_id"),
        )
    )


def blocked_payments(c: Catalog) -> DataFrame:
    k = _k()
    device = F.when(k % 4 == 0, F.concat(F.lit(" device_id:user"), F.col("user_id"), F.lit("@example.com end"))).when(
        k % 4 == 2, F.concat(F.lit(" device_id:dev"), F.col("user_id"))
    )
    return (
        c.table("events")
        .filter(F.col("event_type") == "error")
        .select(
            F.col("user_id").alias("customer_id"),
            _entity().alias("payment_intent_id"),
            F.concat(_entity(), F.lit(" order"), F.coalesce(device, F.lit(""))).alias("description"),
            F.col("value").cast(MONEY).alias("amount"),
            F.col("ts").alias("rule_decision_created"),
            F.col("event_id").alias("row_no"),
        )
    )


def processor_payments(c: Catalog) -> DataFrame:
    return (
        c.table("events")
        .filter(F.col("event_type").isin("error", "purchase"))
        .select(
            F.concat(_entity(), F.lit(" charge")).alias("description"),
            F.when(F.col("event_type") == "error", F.lit("Failed")).otherwise(F.lit("Paid")).alias("status"),
            F.col("value").cast(MONEY).alias("amount"),
            F.col("event_id").alias("row_no"),
        )
    )


def signup_orders(c: Catalog) -> DataFrame:
    """Sign-ups read as orders, in the time span of the events."""
    return (
        c.table("events")
        .filter(F.col("event_type") == "signup")
        .select(
            F.col("user_id").alias("customerId"),
            F.col("ts").alias("createdAt"),
            F.col("ts").alias("created_at"),
            F.lit(1).alias("is_first_order"),
        )
    )


def acquisition_answers(c: Catalog) -> DataFrame:
    return (
        c.table("events")
        .filter(F.col("event_type") == "signup")
        .select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("customerId"),
            F.concat(F.lit("SOURCE_"), _k() % 9).alias("source"),
            F.col("ts").alias("createdAt"),
        )
    )


def discounts(c: Catalog) -> DataFrame:
    """Discounts used by an order, once per name."""
    name = F.when(F.col("l_discount") >= 0.08, F.lit("3x2 bundle")).otherwise(F.lit("other"))
    return (
        c.table("lineitem")
        .groupBy(F.col("l_orderkey").alias("entityId"), name.alias("name"))
        .agg(F.min("l_shipdate").alias("createdAt"))
    )


def intents(c: Catalog) -> DataFrame:
    """A checkout per order line: a priced item, a free one, a second priced one, two discounts."""
    content = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    (F.floor(F.col("l_extendedprice") / 20) / 100).alias("unitPrice"),
                    (1 + F.col("l_quantity").cast("int") % 3).alias("quantity"),
                ),
                F.struct(F.lit(0.0).alias("unitPrice"), F.lit(1).alias("quantity")),
                F.struct(F.round(F.col("l_tax") * 100, 2).alias("unitPrice"), F.lit(1).alias("quantity")),
            ).alias("items"),
            F.array(
                F.struct(
                    F.lit(3.0).alias("value"), F.struct(F.lit("shipping").alias("type")).alias("additionalFields")
                ),
                F.struct(
                    F.round(F.col("l_discount") * 100, 2).alias("value"),
                    F.struct(F.lit(None).cast("string").alias("type")).alias("additionalFields"),
                ),
            ).alias("discounts"),
            F.when(F.col("l_returnflag") == "N", F.lit("CREATED")).otherwise(F.lit("OK")).alias("status"),
            F.struct((F.col("l_linestatus") == "O").alias("subscribed")).alias("additionalFields"),
        )
    )
    return c.table("lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.concat(F.lit("ON"), F.col("l_orderkey"))).alias("orderNumber"),
        F.col("l_shipdate").alias("createdAt"),
        content.alias("content"),
    )


def funnel_steps(c: Catalog) -> DataFrame:
    steps = F.create_map(*[F.lit(x) for p in (("view", 1), ("click", 2), ("signup", 3), ("purchase", 4)) for x in p])
    return (
        c.table("events")
        .filter(F.col("event_type") != "error")
        .groupBy(
            F.when(_k() < 50, F.lit("low")).otherwise(F.lit("high")).alias("funnel"),
            F.dayofmonth("ts").alias("day"),
            F.col("event_type").alias("step"),
        )
        .agg(F.count(F.lit(1)).alias("users"))
        .withColumn("step_no", steps[F.col("step")])
    )


def reviews(c: Catalog) -> DataFrame:
    doc = F.col("doc_id")
    zone = F.when(doc % 3 == 0, F.lit("Z")).when(doc % 3 == 1, F.lit("-05:00")).otherwise(F.lit(""))
    created = F.concat(F.lit("2024-01-"), F.lpad((1 + doc % 28).cast("string"), 2, "0"), F.lit("T23:30:00"), zone)
    sku = (
        F.when(doc % 5 == 0, F.concat(F.lit("77-"), doc))
        .when(doc % 5 == 1, F.lit("KIT1"))
        .when(doc % 5 == 2, (5000 + doc).cast("string"))
        .otherwise(F.concat(F.lit("x"), doc))
    )
    return (
        c.table("documents")
        .join(c.table("labels"), "doc_id", "left")
        .select(
            F.concat(F.lit("Item "), F.col("source")).alias("title"),
            F.struct(
                # Documents without labels: some verified without a rating, others rated without a status.
                F.when(F.col("toxic") == 0, F.lit(" verified_buyer"))
                .when(F.col("toxic") == 1, F.lit("PENDING"))
                .when(doc % 2 == 0, F.lit("VERIFIED"))
                .alias("adminStatus"),
                F.coalesce(3 + F.col("quality") + doc % 2, F.when(doc % 4 != 0, 1 + doc % 5)).cast("string").alias("rating"),
                F.when(F.col("lang") == "en", F.lit("")).otherwise(F.concat(F.lit("Product "), F.col("lang"))).alias("productName"),
                sku.alias("sku"),
                doc.cast("string").alias("orderId"),
                F.col("lang").alias("title"),
                F.col("text").alias("feedBack"),
                F.format_string("User %d", doc).alias("nameOnAmazon"),
                F.format_string("user%d@example.com", doc).alias("email"),
                created.alias("createdAt"),
            ).alias("feedback"),
        )
    )


BUILDERS = {
    f.__name__: f
    for f in (
        orders_light,
        orders_flagged,
        fact_orders,
        order_items,
        fact_order_items,
        sales_orders,
        order_items_raw,
        cancellations,
        subscriptions,
        subscriptions_view,
        subscription_items,
        items_item_groups,
        products,
        customers,
        program_enrollments,
        renewals,
        fees,
        renewal_payments,
        payments,
        payment_attempts,
        blocked_payments,
        processor_payments,
        signup_orders,
        acquisition_answers,
        discounts,
        intents,
        funnel_steps,
        reviews,
    )
}


def catalog(spark: SparkSession, folder: str) -> Catalog:
    return Catalog(spark, folder, BUILDERS)
