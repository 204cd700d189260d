"""Every report over the derived tables, as ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions.scalars import percent_text
from shopledger.operators import (
    basket,
    cancellations,
    cohorts,
    funnel,
    orders,
    payments,
    program,
    promo,
    renewals,
    repurchase,
    reviews,
    subscriptions,
    tracker,
)
from shopledger.operators.core import small_table
from shopledger.plans.fixtures import ITEM_TYPES, catalog
from shopledger.session import tune
from shopledger.sources import readers, sinks
from shopledger.sources.catalog import Catalog
from shopledger.sources.store import StagedCatalog, run_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Periods that take in every row of the tables.
START, END = "1995-01-01", "2001-08-02"
BEFORE, AFTER = "1994-12-31", "2024-12-31"
EVENTS_START, EVENTS_END = "2024-01-01", "2024-02-01"



def _items(*brands: int) -> list[int]:
    """All items of some brands: the same share of the order lines at every size."""
    return [10 * b + t for b in brands for t in range(len(ITEM_TYPES))]


EXCLUDED_ITEMS = _items(1, 2)
KIT_ITEMS = _items(*range(3, 13))
LISTED_ITEMS = _items(*range(1, 5))
CALENDAR_ITEMS = _items(*range(1, 11))
SEGMENTS = {"segment_13": 13, "segment_14": 14, "segment_15": 15}
EXPERIENCE = {"current": ["118", "112"], "before": ["119", "116"], "never": ["120", "114"]}
EXPERIENCE_VARIABLES = (40, 36)
SKIPPED_VARIABLES = (27,)
VARIANT_ITEMS = EXCLUDED_ITEMS[2:4]
SHOWN_EXPERIENCE = {"current": "current", "before": "before", "never": "never", "unknown": "Unknown"}
VARIABLE_LABELS = {4: "KIND", 36: "EXPERIENCE", 40: "EXPERIENCE", 41: "REACTION"}
VALUE_LABELS = {
    13: "A",
    14: "B",
    15: "C",
    112: "CURRENT",
    118: "CURRENT",
    116: "BEFORE",
    119: "BEFORE",
    114: "NEVER",
    120: "NEVER",
    121: "YES",
    122: "NO",
}
WANTED_ANSWERS = {
    "current without reaction": [("EXPERIENCE", "CURRENT"), ("REACTION", "NO")],
    "current with reaction": [("EXPERIENCE", "CURRENT"), ("REACTION", "YES")],
    "never, kind A": [("EXPERIENCE", "NEVER"), ("KIND", "A")],
}
BUNDLES = [["Brand#1", "Brand#2"], ["Brand#3", "Brand#4"], ["Brand#5", "Brand#6", "Brand#7"]]
ADDONS = {
    "addon_a": {"items": _items(1, 2, 3, 4, 5), "base": ["PROMO"]},
    "addon_b": {"items": _items(6, 7), "base": ["PROMO", "ECONOMY"]},
    "addon_c": {"items": _items(8, 9, 10, 11, 12), "base": ["ECONOMY"]},
}
SOURCES = [f"SOURCE_{i}" for i in range(8)]
SKU_RULES = [
    {"type": 7, "prefixes": ["77-"]},
    {"type": 12, "codes": ["KIT1"]},
    {"type": 2, "between": (5000, 5400)},
]
PICTURES = {"KIT1": "kit.jpg", "X3": "x3.jpg"}
PERIODS = {"1995-1997": ("1995-01-01", "1997-12-31"), "1998-2001": ("1998-01-01", "2001-08-02")}


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text, decimals as doubles, doubles to six places: what two engines can compare."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            c = F.round(c.cast("double"), 6)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(build: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
    """Registers a report built from a catalog under its function name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(build(catalog(tune(spark), folder)))

    QUERIES[build.__name__] = run
    return build


# --- orders and sales ---------------------------------------------------------


@query
def daily_orders_kpi(c: Catalog) -> DataFrame:
    return orders.daily_orders_kpi(c.table("fact_orders"), c.table("order_items"), START, END, EXCLUDED_ITEMS)


@query
def valid_items(c: Catalog) -> DataFrame:
    table = orders.valid_items(c.table("fact_orders"), c.table("order_items"), EXCLUDED_ITEMS)
    return table.select("id", "units", "valid_items")


@query
def daily_sales_split(c: Catalog) -> DataFrame:
    return orders.daily_sales_split(c.table("orders_flagged"), START, END)


@query
def expected_vs_obtained_renewals(c: Catalog) -> DataFrame:
    return orders.expected_vs_obtained_renewals(c.table("subscriptions"), c.table("fact_orders"), START, END)


# --- payments -----------------------------------------------------------------


@query
def payment_error_daily(c: Catalog) -> DataFrame:
    return payments.payment_error_daily(c.table("payments"), EVENTS_START, EVENTS_END)


@query
def payment_error_reasons(c: Catalog) -> DataFrame:
    return payments.payment_error_reasons(c.table("payments"), EVENTS_START, EVENTS_END)


@query
def payment_recovery(c: Catalog) -> DataFrame:
    return payments.payment_recovery(c.table("payments"), EVENTS_START, EVENTS_END)


@query
def payment_recovery_summary(c: Catalog) -> DataFrame:
    return payments.recovery_summary(payments.payment_recovery(c.table("payments"), EVENTS_START, EVENTS_END))


@query
def payment_recovery_by_card(c: Catalog) -> DataFrame:
    return payments.payment_recovery_by_card(c.table("payment_attempts"))


@query
def payment_recovery_by_card_summary(c: Catalog) -> DataFrame:
    return payments.recovery_summary(payments.payment_recovery_by_card(c.table("payment_attempts")), True)


@query
def blocked_payments_daily(c: Catalog) -> DataFrame:
    signups = c.table("signup_orders")
    return payments.blocked_payments_daily(
        c.table("blocked_payments"), c.table("processor_payments"), c.table("customers"), signups, signups
    )


# --- subscriptions ------------------------------------------------------------


@query
def subscription_mix(c: Catalog) -> DataFrame:
    return subscriptions.subscription_mix(
        c.table("subscriptions"),
        c.table("orders_flagged"),
        c.table("order_items"),
        START,
        END,
        ["AUTOMOBILE", "BUILDING"],
        ["FURNITURE", "HOUSEHOLD"],
        EXCLUDED_ITEMS,
    )


@query
def addon_subscriptions(c: Catalog) -> DataFrame:
    return subscriptions.addon_subscriptions(
        c.table("subscriptions"),
        c.table("subscription_items"),
        c.table("items_item_groups"),
        BEFORE,
        END,
        {"group_01": ["G0", "G1"], "group_2": ["G2"], "group_3": ["G3"]},
    )


@query
def category_refill(c: Catalog) -> DataFrame:
    return subscriptions.category_refill(
        c.table("orders_flagged"),
        c.table("customers"),
        c.table("fact_order_items"),
        BEFORE,
        END,
        ["SMALL", "LARGE", "MEDIUM"],
        ["PROMO"],
    )


@query
def upsize_attach(c: Catalog) -> DataFrame:
    return subscriptions.upsize_attach(
        c.table("orders_light"),
        c.table("customers"),
        c.table("fact_order_items"),
        BEFORE,
        END,
        ADDONS,
        ["PROMO", "ECONOMY"],
    )


@query
def acquisition_survey(c: Catalog) -> DataFrame:
    return subscriptions.acquisition_survey(
        c.table("orders_flagged"), c.table("acquisition_answers"), START, AFTER, SOURCES
    )


# --- program ------------------------------------------------------------------


@query
def program_snapshot(c: Catalog) -> DataFrame:
    return program.program_snapshot(
        c.table("subscriptions"), c.table("program_enrollments"), c.table("renewals"), BEFORE, END
    )


def _program_base(c: Catalog) -> DataFrame:
    return program.program_enrollment_base(
        c.table("program_enrollments"), c.table("subscriptions"), c.table("renewals"), since=BEFORE
    )


@query
def program_enrollment_base(c: Catalog) -> DataFrame:
    return _program_base(c)


@query
def program_flags(c: Catalog) -> DataFrame:
    flags = program.program_flags(_program_base(c))
    return flags.select(
        "subscription_id",
        "renewal_id",
        "renewal_number",
        "unique_subscription",
        "same_day_reactivation",
        "reactivated_subscription_id",
    )


@query
def monthly_count_table(c: Catalog) -> DataFrame:
    return program.monthly_count_table(
        c.table("orders_flagged"),
        "created_at",
        "total",
        "orders",
        {"status": {"op": "ne", "value": "CANCELLED"}, "is_first_order": 0, "total": {"op": "gte", "value": 1000}},
    )


@query
def monthly_status_table(c: Catalog) -> DataFrame:
    return program.monthly_status_table(
        c.table("orders_light"), "created_at", "id", "order_plan", ["SUBSCRIPTION", "MIXED"], {"status": "PAID"}
    )


def _register_program_tables() -> None:
    for table in program.COUNT_TABLES:
        def counts(c: Catalog, table: str = table) -> DataFrame:
            return program.program_count_table(program.program_flags(_program_base(c)), table)

        counts.__name__ = table
        query(counts)
    for table in program.STATUS_TABLES:
        def statuses(c: Catalog, table: str = table) -> DataFrame:
            return program.program_status_table(program.program_flags(_program_base(c)), table)

        statuses.__name__ = table
        query(statuses)


_register_program_tables()


@query
def program_tracker(c: Catalog) -> DataFrame:
    return program.program_tracker(program.program_flags(_program_base(c)), START, END)


# --- renewals -----------------------------------------------------------------


def _gaps(c: Catalog) -> DataFrame:
    return renewals.renewal_gap_simple(
        c.table("orders_light"), c.table("subscriptions"), c.table("subscriptions_view"), BEFORE, END
    )


@query
def renewal_gap_simple(c: Catalog) -> DataFrame:
    return _gaps(c)


@query
def renewal_gap_comparison(c: Catalog) -> DataFrame:
    return renewals.renewal_gap_comparison(_gaps(c), ["CAT_A", "CAT_B"])


@query
def renewal_payment_errors(c: Catalog) -> DataFrame:
    return renewals.renewal_payment_errors(c.table("orders_light"), c.table("renewals"), c.table("renewal_payments"))


@query
def frequency_changes(c: Catalog) -> DataFrame:
    return renewals.frequency_changes(c.table("fees"), c.table("renewals"))


def _enriched(c: Catalog) -> DataFrame:
    return renewals.renewal_gap_enriched(
        c.table("orders_light"),
        c.table("sales_orders"),
        c.table("subscriptions"),
        c.table("subscriptions_view"),
        renewals.renewal_payment_errors(c.table("orders_light"), c.table("renewals"), c.table("renewal_payments")),
        renewals.frequency_changes(c.table("fees"), c.table("renewals")),
        BEFORE,
        END,
    )


@query
def renewal_gap_enriched(c: Catalog) -> DataFrame:
    return _enriched(c)


@query
def renewal_health_summary(c: Catalog) -> DataFrame:
    return renewals.renewal_health_summary(_enriched(c))


@query
def payment_error_ladder(c: Catalog) -> DataFrame:
    return renewals.payment_error_ladder(_enriched(c))


# --- funnels ------------------------------------------------------------------


@query
def funnel_daily(c: Catalog) -> DataFrame:
    return funnel.funnel_daily(c.table("funnel_steps"))


@query
def funnel_summary(c: Catalog) -> DataFrame:
    return funnel.funnel_summary(c.table("funnel_steps"))


# --- repurchase ---------------------------------------------------------------


def _purchases(c: Catalog) -> DataFrame:
    return repurchase.product_purchases(
        c.table("orders_flagged"), c.table("fact_order_items"), c.table("products"), START, END, "PROMO"
    )


@query
def product_repurchase(c: Catalog) -> DataFrame:
    return repurchase.product_repurchase(_purchases(c))


@query
def repurchase_sample_size(c: Catalog) -> DataFrame:
    return repurchase.sample_size(_purchases(c))


@query
def bundle_repurchase(c: Catalog) -> DataFrame:
    return repurchase.bundle_repurchase(
        c.table("orders_flagged"), c.table("fact_order_items"), c.table("products"), START, END, "PROMO", BUNDLES
    )


def _cohort(c: Catalog) -> DataFrame:
    return repurchase.first_order_cohort(
        c.table("orders_flagged"),
        c.table("fact_order_items"),
        c.table("order_items_raw"),
        START,
        END,
        END,
        "PROMO",
        ["PROMO", "ECONOMY"],
        KIT_ITEMS,
        tracked_items=EXCLUDED_ITEMS,
    )


def _answers(c: Catalog) -> DataFrame:
    return repurchase.labelled_answers(_cohort(c), VARIABLE_LABELS, VALUE_LABELS)


@query
def first_order_cohort(c: Catalog) -> DataFrame:
    table = _cohort(c)
    return table.select(
        "order_id",
        "customer_id",
        F.col("diagnostic").isNotNull().alias("has_diagnostic"),
        "total_custom_orders",
        F.array_sort("tracked_items").alias("tracked_items"),
        "first_order_date",
    )


@query
def repurchase_by_answer(c: Catalog) -> DataFrame:
    return repurchase.repurchase_by_answer(_answers(c), SKIPPED_VARIABLES)


@query
def repurchase_by_answer_variants(c: Catalog) -> DataFrame:
    return repurchase.repurchase_by_answer_variants(_answers(c), SKIPPED_VARIABLES, VARIANT_ITEMS)


@query
def repurchase_by_combination(c: Catalog) -> DataFrame:
    return repurchase.repurchase_by_combination(_answers(c), WANTED_ANSWERS)


@query
def repurchase_period_table(c: Catalog) -> DataFrame:
    cohorts = repurchase.first_order_cohorts(
        c.table("orders_flagged"),
        c.table("fact_order_items"),
        c.table("order_items_raw"),
        PERIODS,
        END,
        "PROMO",
        ["PROMO", "ECONOMY"],
        KIT_ITEMS,
        tracked_items=EXCLUDED_ITEMS,
    )
    answers = repurchase.labelled_answers(cohorts, VARIABLE_LABELS, VALUE_LABELS)
    return repurchase.repurchase_period_table(repurchase.repurchase_by_answer_periods(answers, SKIPPED_VARIABLES), list(PERIODS))


@query
def investor_cohorts(c: Catalog) -> DataFrame:
    facts = cohorts.subscriber_facts(
        c.table("orders_light"),
        c.table("customers"),
        c.table("subscriptions"),
        c.table("cancellations"),
        c.table("order_items_raw"),
        c.table("sales_orders"),
        START,
        END,
        "%1%",
        EXPERIENCE,
        EXPERIENCE_VARIABLES,
        cohorts.last_one_time_order(c.table("orders_light")),
    )
    return cohorts.investor_cohorts(cohorts.with_activity(facts), "1995-01-01", "2001-08-01", list(EXPERIENCE))


# --- cancellations ------------------------------------------------------------


def _cancelled(c: Catalog) -> DataFrame:
    return cancellations.cancellation_base(
        c.table("cancellations"),
        c.table("orders_light"),
        c.table("order_items"),
        c.table("order_items_raw"),
        c.table("sales_orders"),
        START,
        END,
        LISTED_ITEMS,
        KIT_ITEMS,
        list(SEGMENTS.values()),
        EXPERIENCE,
        EXPERIENCE_VARIABLES,
    )


def _last_items(c: Catalog) -> DataFrame:
    return cancellations.cancel_by_last_order(
        c.table("cancellations"),
        c.table("orders_light"),
        c.table("fact_order_items"),
        c.table("subscriptions"),
        START,
        END,
        "PROMO",
        [14, 15, 13],
    )


@query
def cancellation_base(c: Catalog) -> DataFrame:
    return _cancelled(c)


@query
def cancel_by_reason_segment(c: Catalog) -> DataFrame:
    return cancellations.cancel_by_reason_segment(_cancelled(c), SEGMENTS)


@query
def cancel_by_reason_item(c: Catalog) -> DataFrame:
    return cancellations.cancel_by_reason_item(_cancelled(c), LISTED_ITEMS, SEGMENTS)


@query
def cancel_by_reason_experience(c: Catalog) -> DataFrame:
    return cancellations.cancel_by_reason_experience(_cancelled(c), SHOWN_EXPERIENCE)


@query
def active_distribution(c: Catalog) -> DataFrame:
    return cancellations.active_distribution(
        c.table("subscriptions"),
        c.table("orders_light"),
        c.table("subscription_items"),
        START,
        END,
        CALENDAR_ITEMS,
        SEGMENTS,
        EXPERIENCE,
        EXPERIENCE_VARIABLES,
    )


@query
def cancel_by_last_order(c: Catalog) -> DataFrame:
    return _last_items(c)


@query
def cancel_by_last_order_segment(c: Catalog) -> DataFrame:
    level = cancellations.cancellation_level(_last_items(c))
    return cancellations.cancel_by_reason_segment(level, SEGMENTS, blank_is_missing=True)


@query
def cancel_by_last_order_item(c: Catalog) -> DataFrame:
    return cancellations.cancel_by_reason_last_item(_last_items(c), LISTED_ITEMS, SEGMENTS)


def _calendar_rows(c: Catalog) -> DataFrame:
    return cancellations.cancel_item_rows(
        c.table("cancellations"), c.table("subscriptions_view"), c.table("subscription_items"), c.table("products")
    )


@query
def cancel_item_daily(c: Catalog) -> DataFrame:
    return cancellations.cancel_item_daily(_calendar_rows(c), ITEM_TYPES)


@query
def cancel_item_calendar(c: Catalog) -> DataFrame:
    return cancellations.cancel_item_monthly(_calendar_rows(c), ITEM_TYPES)


@query
def cancel_reason_calendar(c: Catalog) -> DataFrame:
    return cancellations.cancel_reason_calendar(
        c.table("cancellations"), c.table("subscription_items"), BEFORE, END, exclude_items=EXCLUDED_ITEMS
    )


# --- promotions ---------------------------------------------------------------


def _promo(c: Catalog) -> DataFrame:
    return promo.promo_daily(c.table("discounts"), c.table("orders_flagged"), BEFORE, AFTER, "3x2")


@query
def promo_daily(c: Catalog) -> DataFrame:
    return promo.promo_comparison(_promo(c))


@query
def promo_means(c: Catalog) -> DataFrame:
    return promo.promo_means(_promo(c))


@query
def promo_recent(c: Catalog) -> DataFrame:
    daily = _promo(c)
    recent = promo.recent_or_all(daily, "discounted", "2001-06-01").select("day", F.col("discounted").alias("n"))
    fallback = promo.recent_or_all(daily, "orders", "2024-01-01").select("day", F.col("orders").alias("n"))
    return recent.withColumn("series", F.lit("discounted")).unionByName(fallback.withColumn("series", F.lit("orders")))


@query
def promo_monthly(c: Catalog) -> DataFrame:
    return promo.promo_monthly(promo.promo_comparison(_promo(c)))


@query
def trend_line(c: Catalog) -> DataFrame:
    monthly = promo.promo_monthly(promo.promo_comparison(_promo(c))).filter(F.col("month") != "TOTAL")
    return promo.trend_line(monthly, "month", "discounted_pct").select("month", "discounted_pct", "trend")


# --- baskets ------------------------------------------------------------------


def _free_shipping(c: Catalog) -> DataFrame:
    return basket.basket_value(c.table("intents"), BEFORE, AFTER, basket.FREE_SHIPPING)


@query
def basket_value(c: Catalog) -> DataFrame:
    return basket.basket_value(c.table("intents"), BEFORE, AFTER)


@query
def basket_summary(c: Catalog) -> DataFrame:
    return basket.basket_summary(c.table("intents"), BEFORE, AFTER, basket.FREE_SHIPPING)


@query
def basket_histogram(c: Catalog) -> DataFrame:
    return basket.basket_histogram(_free_shipping(c))


@query
def basket_units(c: Catalog) -> DataFrame:
    return basket.basket_units(_free_shipping(c))


# --- reviews ------------------------------------------------------------------


@query
def verified_reviews(c: Catalog) -> DataFrame:
    return reviews.verified_reviews(c.table("reviews"))


@query
def verified_reviews_summary(c: Catalog) -> DataFrame:
    return reviews.verified_reviews_summary(c.table("reviews"))


@query
def review_load_set(c: Catalog) -> DataFrame:
    enriched = reviews.verified_reviews(c.table("reviews")).withColumns({"pros": F.lit('["good"]'), "cons": F.lit(" ")})
    loaded = reviews.review_load_set(enriched, SKU_RULES, PICTURES, "https://img.example.com/", "store")
    return loaded


# --- trackers -----------------------------------------------------------------


def _staged(c: Catalog, names: dict[str, list[str] | None], **built: Callable[[Catalog], DataFrame]) -> Catalog:
    """The catalog of one report run, with tables (or those ``built`` from it) that are written once and read often."""
    base = Catalog(c.spark, c.base, {**c.builders, **built}, c.reader, c.options)
    return StagedCatalog(base, run_folder(c.spark, "stage"), {**names, **dict.fromkeys(built)})


def _master_reasons(c: Catalog) -> DataFrame:
    return c.table("orders").select(F.concat(F.lit(" "), F.upper("o_orderpriority")).alias("second")).distinct()


@query
def tracker_merge(c: Catalog) -> DataFrame:
    """The three sheets of the master: answers, reasons by segment, reasons by item with loosely written names.

    The cancellations of both reason sheets are one stage table, as is the master's list of reasons.
    """
    spark = c.spark
    stage = _staged(c, {}, cancelled=_cancelled, master_reasons=_master_reasons)
    reasons = stage.table("master_reasons")

    def every_reason(names: list[str]) -> DataFrame:
        return reasons.withColumn("first", F.explode(F.array(*[F.lit(n) for n in names])))

    pairs = [(v, a) for v in (*VARIABLE_LABELS.values(), "OTHER") for a in (*VALUE_LABELS.values(), "NONE ")]
    answers = small_table(spark, {"first": [p[0] for p in pairs], "second": [p[1] for p in pairs]}, "first string, second string")
    answered = repurchase.repurchase_by_answer(_answers(c), SKIPPED_VARIABLES)
    answered = answered.select(F.col("variable").alias("first"), F.col("value").alias("second"), _percent_text("repurchase_pct"))
    by_segment = cancellations.cancel_by_reason_segment(stage.table("cancelled"), SEGMENTS)
    cells = [F.struct(F.lit(n).alias("first"), _percent_text(f"{n}_pct")) for n in SEGMENTS]
    by_segment = by_segment.select(F.col("reason").alias("second"), F.inline(F.array(*cells)))
    by_item = cancellations.cancel_by_reason_item(stage.table("cancelled"), LISTED_ITEMS, SEGMENTS).filter("segment = 'all'")
    by_item = by_item.select(
        F.concat(F.lit("item-"), "item_id").alias("first"), F.col("reason").alias("second"), _percent_text("share_pct")
    )
    sheets = {
        "answers": (answers.distinct(), answered, []),
        "segments": (every_reason([*SEGMENTS, "segment_99"]), by_segment, []),
        # "ITEM 10" and "Item10" both mean item-10; there is no item 9999.
        "items": (every_reason([f"ITEM {i}" for i in LISTED_ITEMS] + ["Item10", "ITEM 9999"]), by_item, ["first"]),
    }
    merged = [
        tracker.tracker_merge(master, source, ["first", "second"], "share", loose=loose).withColumn("sheet", F.lit(name))
        for name, (master, source, loose) in sheets.items()
    ]
    return reduce(DataFrame.unionByName, merged).select("sheet", "first", "second", "value")


def _percent_text(column: str) -> Column:
    return percent_text(F.round(column, 2)).alias("share")


TRACKED_PERIOD = "1995-2001"


def _sections(c: Catalog) -> dict[str, DataFrame]:
    total = F.col("row_type") == "total"
    orders_kpi = orders.daily_orders_kpi(c.table("fact_orders"), c.table("order_items"), START, END, EXCLUDED_ITEMS)
    sales = orders.daily_sales_split(c.table("orders_flagged"), START, END)
    errors = payments.payment_error_daily(c.table("payments"), EVENTS_START, EVENTS_END)
    return {
        "orders": tracker.as_metrics(orders_kpi.filter(total), ["segment"], ORDER_MEASURES),
        "sales": tracker.as_metrics(sales.filter(total), [], ["daily_no_recurrent", "daily_recurrent"]),
        "payments": tracker.as_metrics(errors.filter(total), [], ["daily_errors", "daily_resolved"]),
        "program": program_snapshot(c),
        "subscriptions": subscription_mix(c),
        "refills": category_refill(c),
        "survey": acquisition_survey(c),
        "addons": tracker.as_metrics(addon_subscriptions(c), ["addon"], ["subscriptions"]),
        "upsize": tracker.as_metrics(upsize_attach(c), ["addon"], UPSIZE_MEASURES),
        "funnels": tracker.as_metrics(funnel_summary(c), ["funnel", "step"], ["users"]),
    }


ORDER_MEASURES = ["revenue", "orders", "valid_items", "avg_items", "avg_value"]
UPSIZE_MEASURES = ["base_orders", "upsized_orders", "pieces"]


#: Inputs that several sections of the tracker read.
TRACKER_INPUTS = {"orders_flagged": None, "fact_order_items": None, "order_items": None, "subscriptions": None}


@query
def kpi_tracker(c: Catalog) -> DataFrame:
    """All sections over inputs that are staged once for the month."""
    return tracker.kpi_tracker(TRACKED_PERIOD, _sections(_staged(c, TRACKER_INPUTS)))


@query
def kpi_tracker_update(c: Catalog) -> DataFrame:
    """A tracker of two sections, updated with a corrected section and a further period."""
    sections = {name: df for name, df in _sections(c).items() if name in ("survey", "addons")}
    known = tracker.kpi_tracker(TRACKED_PERIOD, sections)
    corrected = sections["addons"].withColumn("value", F.col("value") * 2)
    fresh = tracker.kpi_tracker(TRACKED_PERIOD, {"addons": corrected})
    fresh = fresh.unionByName(tracker.kpi_tracker("2002", {"addons": corrected}))
    return tracker.tracker_update(known, fresh)


# --- stored trackers and loads ------------------------------------------------


@query
def kpi_tracker_store(c: Catalog) -> DataFrame:
    """The tracker of ``kpi_tracker_update``, kept in a folder: two sections, then a corrected one and a further period."""
    path = run_folder(c.spark, "tracker")
    # Every update reads its section again.
    built = {name: lambda _, df=df: df for name, df in _sections(c).items() if name in ("survey", "addons")}
    stage = _staged(c, {}, **built)
    sections = {name: stage.table(name) for name in built}
    for name, df in sections.items():
        sinks.write_kpis(tracker.kpi_tracker(TRACKED_PERIOD, {name: df}), path)
    corrected = sections["addons"].withColumn("value", F.col("value") * 2)
    for period in (TRACKED_PERIOD, "2002"):
        sinks.write_kpis(tracker.kpi_tracker(period, {"addons": corrected}), path)
    return sinks.read_kpis(c.spark, path)


@query
def review_load_twice(c: Catalog) -> DataFrame:
    """Reviews loaded in part, then all, then all again: each is there once."""
    path = run_folder(c.spark, "reviews")
    whole = review_load_set(c)
    sinks.load_reviews(whole.filter("overall_rating = 5"), path, "five stars")
    for batch in ("all", "all", None):
        sinks.load_reviews(whole, path, batch)
    return sinks.loaded_reviews(c.spark, path).select(*whole.columns)


# --- files --------------------------------------------------------------------


def _csv(rows: DataFrame, path: str, **options) -> str:
    """Writes rows in the order of their number, so that file order is that order."""
    ordered = rows.repartitionByRange("row_no").sortWithinPartitions("row_no").drop("row_no")
    ordered.write.csv(path, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options)
    return path


@query
def blocked_payment_files(c: Catalog) -> DataFrame:
    """Blocked payments per day from the two CSV exports."""
    folder = run_folder(c.spark, "files")
    blocked = readers.read_blocked_payments(c.spark, _csv(c.table("blocked_payments"), f"{folder}/blocked"))
    names = {"description": "Description", "status": "Status", "amount": "Amount"}
    settled = _csv(c.table("processor_payments").withColumnsRenamed(names), f"{folder}/payments")
    signups = c.table("signup_orders")
    settled = readers.read_processor_payments(c.spark, settled)
    return payments.blocked_payments_daily(blocked, settled, c.table("customers"), signups, signups)


@query
def payment_attempt_file(c: Catalog) -> DataFrame:
    """Recovery by card from a CSV export in Latin-1."""
    rows = c.table("payment_attempts").withColumn("row_no", F.col("created_utc"))
    # Whole seconds would leave the order of attempts of one second open.
    rows = rows.withColumn("created_utc", F.date_format("created_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    rows = rows.withColumn("note", F.lit("niño")).withColumnsRenamed({v: k for k, v in readers.ATTEMPT_COLUMNS.items()})
    path = _csv(rows, run_folder(c.spark, "files"), encoding="ISO-8859-1")
    return payments.payment_recovery_by_card(readers.read_payment_attempts(c.spark, path, "ISO-8859-1"))


@query
def funnel_files(c: Catalog) -> DataFrame:
    """Daily funnels from one export for each funnel, with headers of their own behind nine lines."""
    steps = c.table("funnel_steps")
    title = F.concat(F.col("step_no"), F.lit(". "), F.col("step"))
    per_day = steps.groupBy("funnel", "day").agg(F.map_from_entries(F.collect_list(F.struct("step_no", "users"))).alias("users"))
    columns = steps.groupBy("funnel").agg(F.array_sort(F.collect_set(F.struct("step_no", title.alias("title")))).alias("columns"))
    # One funnel has its steps backwards and a column that is no step.
    shown = F.when(F.col("funnel") == "low", F.reverse("columns")).otherwise(F.col("columns"))
    columns = columns.select("funnel", shown.alias("columns"))
    cells = F.transform("columns", lambda s: F.coalesce(F.try_element_at("users", s["step_no"]).cast("string"), F.lit("")))
    extra = F.when(F.col("funnel") == "low", F.lit(",Ingreso Active users")).otherwise("")
    lines = per_day.join(columns, "funnel").groupBy("funnel", "columns").agg(
        F.array_sort(F.collect_list(F.struct("day", F.concat(F.col("day"), F.lit(","), F.array_join(cells, ",")).alias("line")))).alias("days")
    )
    header = F.concat(F.lit("Day,"), F.array_join(F.col("columns")["title"], ","), extra)
    text = F.concat(F.lit("# export\n" * 9), header, F.lit("\r\n"), F.array_join(F.col("days")["line"], "\r\n"))
    path = run_folder(c.spark, "files")
    lines.select("funnel", text.alias("value")).write.partitionBy("funnel").text(path)
    # A blank cell stands for a step that the table has no row for on that day.
    return funnel.funnel_daily(readers.read_funnel_csv(c.spark, path).filter("users is not null"))


@query
def review_documents(c: Catalog) -> DataFrame:
    """Verified reviews from JSON documents of up to 500 items each."""
    items = c.table("reviews").withColumn("shard", F.floor(F.col("feedback.orderId").cast("long") / 500))
    whole = F.to_json(F.struct(F.collect_list(F.struct("title", "feedback")).alias("itemsList")))
    path = run_folder(c.spark, "files")
    items.groupBy("shard").agg(whole.alias("value")).write.partitionBy("shard").text(path)
    found = readers.read_reviews(c.spark, path)
    return reviews.verified_reviews(found)


@query
def enriched_review_file(c: Catalog) -> DataFrame:
    """The load set from an enriched CSV whose column names are written loosely and whose texts run over lines."""
    rows = reviews.verified_reviews(c.table("reviews")).withColumns({"pros": F.lit('["good"]'), "cons": F.lit(" ")})
    loose = rows.toDF(*[f" {n.upper()} " for n in rows.columns]).withColumn("row_no", F.xxhash64(F.struct("*")))
    enriched = readers.read_enriched_reviews(c.spark, _csv(loose, run_folder(c.spark, "files")))
    return reviews.review_load_set(enriched, SKU_RULES, PICTURES, "https://img.example.com/", "store")
