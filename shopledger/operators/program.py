"""The renewal program: enrolments, renewals after enrolment, monthly tracker."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.periods import in_period, lenient_date, local_date, month_label, month_of
from shopledger.functions.predicates import build_predicate, require_columns
from shopledger.functions.scalars import percent
from shopledger.operators.core import calendar, metric_rows, numbered


def program_snapshot(
    subscriptions: DataFrame,
    enrollments: DataFrame,
    renewals: DataFrame,
    start: str,
    end: str,
    zone: str = "America/Los_Angeles",
) -> DataFrame:
    """Members, new members, and members who renewed more than a day after enrolling.

    ``subscriptions`` carries id, status and sms_renewal. New members need a
    renewal of any status; the renewal count counts members, not renewals.
    """
    members = subscriptions.filter((F.col("sms_renewal") == 1) & (F.col("status") != "CANCELLED")).agg(
        F.countDistinct("id").alias("members")
    )
    known = subscriptions.select(F.col("id").alias("subscription_id")).distinct()
    enrolled = enrollments.join(known, "subscription_id", "left_semi").withColumn(
        "start_date", local_date(F.col("first_date"), zone)
    )
    renewed_ids = renewals.select(F.col("subscriptionId").alias("subscription_id")).distinct()
    new = (
        enrolled.filter(in_period(F.col("first_date"), start, end, "()"))
        .join(renewed_ids, "subscription_id", "left_semi")
        .select("subscription_id", "start_date")
        .distinct()
        .agg(F.count(F.lit(1)).alias("new_members"))
    )
    success = renewals.filter((F.col("status") == "SUCCESS") & (F.col("createdAt") > F.lit(start))).select(
        F.col("subscriptionId").alias("subscription_id"), "createdAt"
    )
    after = (F.col("createdAt") > F.col("first_date") + F.expr("interval 1 day")) & (
        F.col("last_date").isNull() | (F.col("createdAt") < F.col("last_date"))
    )
    renewed = (
        success.join(enrolled, "subscription_id")
        .filter(after)
        .select("subscription_id", "start_date")
        .distinct()
        .agg(F.count(F.lit(1)).alias("renewed_members"))
    )
    names = ["members", "new_members", "renewed_members"]
    totals = (
        members.unionByName(new, allowMissingColumns=True)
        .unionByName(renewed, allowMissingColumns=True)
        .agg(*[F.max(n).alias(n) for n in names])
    )
    return metric_rows(
        totals,
        {
            "new_members_pct": F.round(percent(F.col("new_members"), F.col("members")), 2),
            **{n: F.col(n) for n in names},
        },
    )


def program_enrollment_base(
    enrollments: DataFrame,
    subscriptions: DataFrame,
    renewals: DataFrame,
    since: str = "2023-01-01 08:00:00",
    zone: str = "America/Los_Angeles",
) -> DataFrame:
    """One row per enrolment and successful renewal inside it (one with no renewal if there is none).

    Matching renewals come from an inner join, which can be split where one
    subscription has very many; enrolments without any are added after, found
    by renewal days instead of renewals. ``renewed_at_once`` says whether the
    subscription's first row renewed on its start day.
    """
    facts = subscriptions.select(
        F.col("id").alias("subscription_id"),
        F.get_json_object("additionalFields", "$.sms_renewal").alias("program_active"),
        F.col("status").alias("subscription_status"),
    )
    enrolled = enrollments.filter(F.col("first_date") > F.lit(since)).join(facts, "subscription_id")
    success = renewals.filter(F.col("status") == "SUCCESS").select(
        F.col("subscriptionId").alias("subscription_id"), F.col("id").alias("renewal_id"), F.col("createdAt").alias("renewed_at")
    )

    def during(day: Column) -> Column:
        return (day >= F.to_date("first_date")) & (F.col("last_date").isNull() | (day <= F.to_date("last_date")))

    matched = success.join(enrolled, "subscription_id").filter(during(F.to_date("renewed_at")))
    renewal_days = success.select("subscription_id", F.to_date("renewed_at").alias("_renewal_day")).distinct()
    same = (enrolled["subscription_id"] == renewal_days["subscription_id"]) & during(F.col("_renewal_day"))
    unmatched = enrolled.join(renewal_days, same, "left_anti")
    rows = matched.unionByName(unmatched, allowMissingColumns=True).withColumns(
        {"start_date": local_date(F.col("first_date"), zone), "renewal_date": local_date(F.col("renewed_at"), zone)}
    )
    ordered = numbered(
        rows, ["subscription_id"], "renewed_at", ["renewal_id"], "row_in_subscription", ["start_date", "renewal_date"]
    )
    at_once = F.coalesce(F.col("first_start_date") == F.col("first_renewal_date"), F.lit(False))
    return ordered.select(
        "subscription_id",
        "start_date",
        "renewal_date",
        local_date(F.col("last_date"), zone).alias("end_date"),
        "renewal_id",
        "row_in_subscription",
        F.when(F.col("renewed_at").isNull(), F.lit(0)).otherwise(F.col("row_in_subscription")).alias("renewal_number"),
        "program_active",
        "subscription_status",
        at_once.alias("renewed_at_once"),
    )


def program_flags(base: DataFrame) -> DataFrame:
    """Adds: first row of its subscription, renewed on the start day, and the ids that ever did so."""
    required = ["start_date", "renewal_date", "end_date", "subscription_id", "renewal_number", "renewed_at_once"]
    require_columns(base, required, "program_flags")
    same_day = F.coalesce((F.col("start_date") == F.col("renewal_date")) & (F.col("renewal_number") == 1), F.lit(False))
    flagged = base.withColumn("unique_subscription", (F.col("row_in_subscription") == 1).cast("int")).withColumn(
        "same_day_reactivation", same_day.cast("int")
    )
    return flagged.withColumn("reactivated_subscription_id", F.when(F.col("renewed_at_once"), F.col("subscription_id")))


# --- monthly tables -----------------------------------------------------------


def _month_columns(df: DataFrame, date_column: str) -> DataFrame:
    """Rows with a readable date, and its year, month number and label."""
    kind = df.schema[date_column].dataType.typeName()
    date = F.col(date_column) if kind in ("date", "timestamp", "timestamp_ntz") else lenient_date(F.col(date_column))
    return (
        df.withColumn("_date", date)
        .filter(F.col("_date").isNotNull())
        .withColumn("year", F.year("_date"))
        .withColumn("month_number", F.month("_date"))
        .withColumn("month", month_label(F.col("_date")))
    )


def monthly_count_table(
    df: DataFrame, date_column: str, value_column: str, name: str, filters: dict[str, Any] | None = None
) -> DataFrame:
    """Present values per month of the rows passing ``filters``."""
    require_columns(df, [date_column, value_column, *(filters or {})], "monthly_count_table")
    return (
        _month_columns(df, date_column)
        .filter(build_predicate(df, filters) & F.col(value_column).isNotNull())
        .groupBy("year", "month_number", "month")
        .agg(F.count(value_column).alias(name))
    )


def monthly_status_table(
    df: DataFrame,
    date_column: str,
    value_column: str,
    status_column: str,
    statuses: Sequence[str],
    filters: dict[str, Any] | None = None,
) -> DataFrame:
    """Present values per month and status (one column each), with their sum."""
    require_columns(df, [date_column, value_column, status_column, *(filters or {})], "monthly_status_table")
    counts = [F.count_if(F.col(status_column) == s).alias(s) for s in statuses]
    return (
        _month_columns(df, date_column)
        .filter(build_predicate(df, filters) & F.col(value_column).isNotNull())
        .filter(F.col(status_column).isin(list(statuses)))
        .groupBy("year", "month_number", "month")
        .agg(*counts, F.count(F.lit(1)).alias("total"))
    )


# What each tracker table counts, by which date, over which rows.
COUNT_TABLES: dict[str, tuple[str, str, dict[str, Any]]] = {
    "customers_joined": ("start_date", "subscription_id", {"unique_subscription": 1}),
    "reactivation_renewals": ("renewal_date", "same_day_reactivation", {"same_day_reactivation": 1}),
    "same_day_and_again": (
        "start_date",
        "subscription_id",
        {"renewal_number": 2, "reactivated_subscription_id": {"op": "notna"}},
    ),
    "first_renewal_not_reactivation": (
        "start_date",
        "subscription_id",
        {"renewal_number": 1, "same_day_reactivation": 0},
    ),
    "no_renewals_yet": ("start_date", "subscription_id", {"renewal_number": 0}),
    "all_renewals": ("renewal_date", "subscription_id", {"renewal_number": {"op": "ne", "value": 0}}),
    "second_renewal": ("renewal_date", "subscription_id", {"renewal_number": 2}),
    "second_or_more": ("renewal_date", "subscription_id", {"renewal_number": {"op": "gt", "value": 1}}),
}
STATUS_TABLES: dict[str, list[str]] = {
    "active_processing": ["ACTIVE", "PROCESSING"],
    "active_processing_onhold": ["ACTIVE", "PROCESSING", "ON_HOLD"],
}


def program_count_table(flags: DataFrame, table: str) -> DataFrame:
    """One of ``COUNT_TABLES`` by name."""
    date_column, value_column, filters = COUNT_TABLES[table]
    return monthly_count_table(flags, date_column, value_column, "count", filters)


def program_status_table(flags: DataFrame, table: str) -> DataFrame:
    """One of ``STATUS_TABLES`` by name."""
    return monthly_status_table(
        flags, "start_date", "subscription_id", "subscription_status", STATUS_TABLES[table], {"unique_subscription": 1}
    )


def program_tracker(flags: DataFrame, start: str, end: str) -> DataFrame:
    """All ten monthly figures for every month from ``start`` to ``end``, 0 where nothing happened.

    Every row counts once under its start month and once under its renewal
    month, so the ten tables come out of a single pass.
    """
    def figure(by: str, value_column: str, filters: dict[str, Any]):
        rows = build_predicate(flags, filters) & F.col(value_column).isNotNull() & (F.col("_by") == by)
        return F.count_if(rows)

    figures = {name: figure(by, value, filters) for name, (by, value, filters) in COUNT_TABLES.items()}
    for name, statuses in STATUS_TABLES.items():
        figures[name] = figure(
            "start_date",
            "subscription_id",
            {"unique_subscription": 1, "subscription_status": {"op": "in", "values": statuses}},
        )
    dates = F.array(
        *[F.struct(F.lit(by).alias("_by"), month_of(F.col(by)).alias("month")) for by in ("start_date", "renewal_date")]
    )
    monthly = (
        flags.select("*", F.inline(dates))
        .filter(F.col("month").isNotNull())
        .groupBy("month")
        .agg(*[f.alias(n) for n, f in figures.items()])
    )
    months = calendar(flags.sparkSession, start, end, "1 month", "month").withColumn("month", F.trunc("month", "MM"))
    filled = months.join(monthly, "month", "left").na.fill(0, list(figures))
    return metric_rows(filled, {n: F.col(n) for n in figures}, ["month"])
