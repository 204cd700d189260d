"""How often subscriptions really renew, against what was configured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.functions.periods import calendar_days_between, elapsed_days_between, in_period
from shopledger.functions.scalars import days_as_weeks, every_n_weeks, in_parentheses, percent
from shopledger.operators.core import change_points, latest_two, metric_rows

PROGRAM, NO_PROGRAM, EVERYONE = "program", "no_program", "all"


def _in_cohorts(rows: DataFrame, flag: Column) -> DataFrame:
    """Each row once for its own cohort by the program flag (text) and once for everyone."""
    own = F.when(flag == "true", F.lit(PROGRAM)).when((flag == "false") | flag.isNull(), F.lit(NO_PROGRAM))
    return rows.withColumn("cohort", F.explode(F.array(own, F.lit(EVERYONE)))).filter(F.col("cohort").isNotNull())


def renewal_gap_simple(
    orders: DataFrame, subscriptions: DataFrame, subscriptions_view: DataFrame, start: str, end: str
) -> DataFrame:
    """Elapsed days between the last two orders of subscriptions created in ``(start, end)``.

    The three cohorts come from one pass: each subscription counts in its own
    cohort and in ``all``.
    """
    live = orders.filter((F.col("status") != "CANCELLED") & F.col("subscription_id").isNotNull())
    last_two = latest_two(live, ["subscription_id"], "created_at", "id").filter(F.col("second_last_ts").isNotNull())
    facts = subscriptions.filter(
        (F.col("status") != "CANCELLED") & in_period(F.col("createdAt"), start, end, "()")
    ).select(
        F.col("id").alias("subscription_id"),
        F.get_json_object("additionalFields", "$.sms_renewal").alias("_flag"),
    )
    view = subscriptions_view.select("subscription_id", "legacy_category", "delivery_frequency")
    days = elapsed_days_between(F.col("last_ts"), F.col("second_last_ts"))
    rows = last_two.join(facts, "subscription_id").join(view, "subscription_id")
    return (
        _in_cohorts(rows, F.col("_flag"))
        .select(
            "cohort",
            "subscription_id",
            days.alias("days_between_orders"),
            (days / F.lit(7.0)).alias("weeks_between_orders"),
            days_as_weeks(F.col("delivery_frequency")).alias("frequency_weeks"),
            F.col("legacy_category").alias("category"),
        )
    )


def renewal_gap_comparison(gaps: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Average and modes of configured and actual frequency, in weeks and days, per cohort.

    A category without rows shows 0; a series without values shows "No data".
    """
    rows = gaps.select(
        "cohort",
        "category",
        F.inline(
            F.array(
                F.struct(
                    F.lit("configured").alias("series"),
                    F.col("frequency_weeks").alias("weeks"),
                    (F.col("frequency_weeks") * 7).alias("days"),
                ),
                F.struct(
                    F.lit("actual").alias("series"),
                    F.col("weeks_between_orders").alias("weeks"),
                    F.col("days_between_orders").cast("double").alias("days"),
                ),
            )
        ),
    )
    own = F.when((F.col("series") == "actual") & F.col("category").isin(list(categories)), F.col("category"))
    series = rows.withColumn("series", F.explode(F.array_compact(F.array("series", own)))).drop("category")
    listed = F.array(*[F.lit(s) for s in ("configured", "actual", *categories)])
    # The distinct gaps are few: averages and modes of a series are taken from its counts.
    counted = series.groupBy("cohort", "series", "weeks", "days").agg(F.count(F.lit(1)).alias("n"))
    weighted = F.when(F.col("weeks").isNotNull(), F.col("n"))
    per_series = counted.groupBy("cohort", "series").agg(
        (F.sum(F.col("days") * F.col("n")) / F.sum(weighted)).alias("avg_days"),
        F.sum("n").alias("rows"),
        F.array_sort(
            F.collect_list(F.when(F.col("weeks").isNotNull(), F.struct((-F.col("n")).alias("order"), "days", "weeks")))
        ).alias("gaps"),
    )
    tied = F.filter(F.slice("gaps", 1, 3), lambda g: g["order"] == F.col("gaps")[0]["order"])

    def texts(name: str) -> Column:
        ordered = F.array_sort(F.transform(tied, lambda g: g[name]))
        joined = F.array_join(F.transform(ordered, lambda v: F.format_string("%.2f", v)), ", ")
        return F.when(F.size("gaps") > 0, joined)

    found = F.struct("avg_days", "rows", texts("weeks").alias("mode_weeks"), texts("days").alias("mode_days"))
    per_cohort = per_series.groupBy("cohort").agg(F.map_from_entries(F.collect_list(F.struct("series", found))).alias("found"))
    spine = per_cohort.withColumn("series", F.explode(listed))
    keys = ["cohort", "series"]
    no_rows = F.col("rows").isNull()
    return (
        spine.withColumn("_one", F.try_element_at("found", "series"))
        .select(*keys, "_one.*")
        .select(
            *keys,
            F.when(no_rows, F.lit(0.0)).otherwise(F.col("avg_days") / 7).alias("avg_weeks"),
            F.when(no_rows, F.lit(0.0)).otherwise(F.col("avg_days")).alias("avg_days"),
            F.when(no_rows, F.lit("0.00")).otherwise(F.coalesce("mode_weeks", F.lit("No data"))).alias("mode_weeks"),
            F.when(no_rows, F.lit("0.00")).otherwise(F.coalesce("mode_days", F.lit("No data"))).alias("mode_days"),
        )
    )


def renewal_payment_errors(
    orders: DataFrame, renewals: DataFrame, payments: DataFrame, renewal_prefix: str = "RE"
) -> DataFrame:
    """Failed attempts per subscription between its last two orders (attempts beyond the first, per renewal)."""
    live = orders.filter((F.col("status") != "CANCELLED") & F.col("subscription_id").isNotNull())
    ranges = latest_two(live, ["subscription_id"], "created_at", "id").filter(F.col("second_last_ts").isNotNull())
    windows = renewals.select(F.col("id").alias("entityId"), F.col("subscriptionId").alias("subscription_id")).join(
        ranges, "subscription_id"
    )
    return (
        payments.filter(F.col("entityId").startswith(renewal_prefix))
        .select("entityId", "createdAt")
        .join(windows, "entityId")
        .filter(F.col("createdAt").between(F.col("second_last_ts"), F.col("last_ts")))
        .groupBy("subscription_id", "entityId")
        .agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("errors"))
        .groupBy("subscription_id")
        .agg(F.sum("errors").alias("payment_errors"))
    )


def frequency_changes(
    fees: DataFrame,
    renewals: DataFrame,
    renewal_prefix: str = "RE",
    description_prefix: str = "Sub",
) -> DataFrame:
    """Moments at which a subscription's billed frequency changed, for those with more than one frequency."""
    base = (
        fees.filter(
            F.col("description").startswith(description_prefix) & F.col("entityId").startswith(renewal_prefix)
        )
        .join(renewals.select(F.col("id").alias("entityId"), F.col("subscriptionId").alias("subscription_id")), "entityId")
        .select(
            "subscription_id",
            F.col("createdAt").alias("changed_at"),
            F.col("entityId").alias("renewal_id"),
            in_parentheses(F.col("description")).alias("frequency"),
        )
    )
    changes = change_points(
        base, ["subscription_id"], "changed_at", ["renewal_id", "frequency"], "frequency", "previous_frequency"
    )
    return changes.filter("several").drop("several")


def recent_frequencies(changes: DataFrame) -> DataFrame:
    """``subscription_id, dates, difference``: the last date of each frequency, and the step between the latest two.

    Only "Every N weeks" counts; the frequencies of one subscription are few.
    """
    last_dates = (
        changes.withColumn("weeks", every_n_weeks(F.col("frequency")))
        .filter(F.col("weeks").isNotNull())
        .groupBy("subscription_id", "frequency", "weeks")
        .agg(F.max("changed_at").alias("changed_at"))
    )
    order = W.partitionBy("subscription_id").orderBy(F.desc("changed_at"), "frequency")
    second = F.date_trunc("second", F.col("changed_at")).cast("timestamp_ntz")
    nth = lambda n: F.max(F.when(F.col("_n") == n, F.col("weeks")))
    return (
        last_dates.withColumn("_n", F.row_number().over(order))
        .groupBy("subscription_id")
        .agg(F.collect_list(second).alias("dates"), (nth(1) - nth(2)).alias("difference"))
    )


def _changed_inside() -> Column:
    return F.exists("dates", lambda d: d.between(F.col("second_last_ts"), F.col("last_ts")))


def frequency_change_summary(
    changes: DataFrame, windows: DataFrame, keys: Sequence[str] = ("subscription_id",)
) -> DataFrame:
    """Windows (by ``keys``) with a frequency change inside, and its size in weeks.

    ``windows``: the keys, last_ts and second_last_ts. A frequency counts with
    its last date; only "Every N weeks" counts at all. The difference is that of
    the subscription's two most recent frequencies.
    """
    found = windows.select(*keys, "last_ts", "second_last_ts").join(recent_frequencies(changes), "subscription_id")
    return found.filter(_changed_inside()).select(*keys, F.col("difference").alias("frequency_change_weeks")).distinct()


def renewal_gap_enriched(
    orders: DataFrame,
    sales_orders: DataFrame,
    subscriptions: DataFrame,
    subscriptions_view: DataFrame,
    payment_errors: DataFrame,
    changes: DataFrame,
    start: str,
    end: str,
) -> DataFrame:
    """Calendar days between the last two orders of the period, with snooze, payment errors and frequency change.

    Unlike the simple report, the cohort is decided by the *order*, so the last
    two orders are taken per cohort.
    """
    flags = sales_orders.select("id", F.get_json_object("additionalFields", "$.sms_renewal").alias("_flag"))
    live = _in_cohorts(
        orders.filter(
            (F.col("status") != "CANCELLED")
            & F.col("subscription_id").isNotNull()
            & in_period(F.col("created_at"), start, end, "()")
        )
        .select("id", "subscription_id", "created_at")
        .join(flags, "id"),
        F.col("_flag"),
    )
    keys = ["cohort", "subscription_id"]
    last_two = latest_two(live, keys, "created_at", "id").filter(F.col("second_last_ts").isNotNull())
    facts = subscriptions.select(
        F.col("id").alias("subscription_id"), F.get_json_object("additionalFields", "$.snooze").alias("_snooze")
    ).join(subscriptions_view.select("subscription_id", "legacy_category", "delivery_frequency"), "subscription_id")
    windows = last_two.join(facts, "subscription_id")
    changed = F.coalesce(_changed_inside(), F.lit(False))
    days = calendar_days_between(F.col("last_ts"), F.col("second_last_ts"))
    return (
        windows.join(payment_errors, "subscription_id", "left")
        .join(recent_frequencies(changes), "subscription_id", "left")
        .select(
            "cohort",
            "subscription_id",
            F.col("legacy_category").alias("category"),
            days.alias("days_between_orders"),
            (days / F.lit(7.0)).alias("weeks_between_orders"),
            days_as_weeks(F.col("delivery_frequency")).alias("frequency_weeks"),
            F.when(F.trim("_snooze") == "1", F.lit(1)).otherwise(F.lit(0)).alias("snooze"),
            F.coalesce("payment_errors", F.lit(0)).alias("payment_errors"),
            changed.alias("frequency_change_in_period"),
            F.when(changed, F.col("difference")).alias("frequency_change_weeks"),
        )
    )


def renewal_health_summary(enriched: DataFrame) -> DataFrame:
    """Totals and shares of snoozed, failing and re-timed subscriptions, per cohort."""
    totals = enriched.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("snooze").alias("snooze"),
        F.count_if(F.col("payment_errors") > 0).alias("errors"),
        F.count_if("frequency_change_in_period").alias("changes"),
        F.coalesce(F.avg("frequency_change_weeks"), F.lit(0.0)).alias("avg_change"),
    )
    return metric_rows(
        totals,
        {
            "subscriptions": F.col("total"),
            "with_snooze": F.col("snooze"),
            "with_payment_errors": F.col("errors"),
            "with_frequency_change": F.col("changes"),
            "snooze_pct": percent(F.col("snooze"), F.col("total")),
            "payment_errors_pct": percent(F.col("errors"), F.col("total")),
            "frequency_change_pct": percent(F.col("changes"), F.col("total")),
            "avg_frequency_change_weeks": F.col("avg_change"),
        },
        ["cohort"],
    )


def payment_error_ladder(enriched: DataFrame, thresholds: Sequence[int] = tuple(range(2, 11))) -> DataFrame:
    """Subscriptions with at least n payment errors, per cohort."""
    counts = enriched.groupBy("cohort").agg(
        *[F.count_if(F.col("payment_errors") >= n).alias(f"n{n}") for n in thresholds]
    )
    rungs = F.array(
        *[F.struct(F.lit(n).alias("threshold"), F.col(f"n{n}").alias("subscriptions")) for n in thresholds]
    )
    return counts.select("cohort", F.inline(rungs))
