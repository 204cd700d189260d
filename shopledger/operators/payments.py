"""Payment errors, their recovery, and blocked payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.periods import day_of, in_period
from shopledger.functions.scalars import (
    decline_code,
    first_word,
    is_truthy,
    normalized_status,
    percent,
    safe_ratio,
    word_after,
)
from shopledger.operators.core import metric_rows, value_counts, with_totals


def _months_back(start: str, months: int) -> str:
    """The day of ``start`` moved back by calendar months, as SQL would."""
    year, month, day = (int(part) for part in start[:10].split("-"))
    index = year * 12 + month - 1 - months
    year, month = divmod(index, 12)
    leap = year % 4 == 0 and (year % 100 != 0 or year % 400 == 0)
    last = [31, 29 if leap else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][month]
    return f"{year:04d}-{month + 1:02d}-{min(day, last):02d}"


def payment_outcomes(payments: DataFrame, start: str, end: str, look_back_months: int = 1) -> DataFrame:
    """One row per paid-for entity: first error, when it was resolved.

    The first error counts only if the very first attempt failed. An entity with
    a failure and a success is resolved on the day of its first success, even
    where that success came first.
    """
    attempts = payments.filter(
        in_period(F.col("createdAt"), _months_back(start, look_back_months), end) & F.col("entityId").isNotNull()
    )
    first = F.min(F.struct("createdAt", "id", "status", "metadata"))
    failed = F.col("status") == "FAILED"
    success = F.col("status") == "SUCCESS"
    return (
        attempts.groupBy("entityId")
        .agg(
            first.alias("first"),
            F.max(F.when(failed, 1)).alias("any_failed"),
            F.min(F.when(success, F.col("createdAt"))).alias("first_success"),
        )
        .select(
            "entityId",
            F.when(F.col("first.status") == "FAILED", day_of(F.col("first.createdAt"))).alias("first_error_date"),
            F.when(F.col("any_failed") == 1, day_of(F.col("first_success"))).alias("resolved_date"),
            F.when(F.col("first.status") == "FAILED", F.col("first.metadata")).alias("metadata"),
        )
    )


def payment_error_daily(payments: DataFrame, start: str, end: str) -> DataFrame:
    """Errors and resolutions per day since ``start``, with totals and means over the listed days."""
    outcomes = payment_outcomes(payments, start, end)
    dates = F.array(
        F.struct(F.col("first_error_date").alias("day"), F.lit(1).alias("error"), F.lit(0).alias("resolved")),
        F.struct(F.col("resolved_date").alias("day"), F.lit(0).alias("error"), F.lit(1).alias("resolved")),
    )
    daily = (
        outcomes.select(F.inline(dates))
        .filter(F.col("day") >= F.lit(start).cast("date"))
        .groupBy("day")
        .agg(F.sum("error").alias("daily_errors"), F.sum("resolved").alias("daily_resolved"))
    )
    return with_totals(daily, ["daily_errors", "daily_resolved"], mean=True)


def payment_error_reasons(
    payments: DataFrame, start: str, end: str, code_path: str = "$.stripeError.error.decline_code"
) -> DataFrame:
    """Decline codes of the first errors since ``start``, most frequent first."""
    errors = payment_outcomes(payments, start, end).filter(F.col("first_error_date") >= F.lit(start).cast("date"))
    return value_counts(errors.select(decline_code(F.col("metadata"), code_path).alias("decline_code")), "decline_code", "error_count")


def payment_recovery(
    payments: DataFrame, start: str, end: str, backup_path: str = "$.isBackupPayment"
) -> DataFrame:
    """Per entity: attempts, whether it failed, whether the last attempt resolved it, and by which method."""
    rows = payments.filter(in_period(F.col("createdAt"), start, end) & F.col("entityId").isNotNull()).select(
        "entityId",
        "createdAt",
        "id",
        "customerId",
        normalized_status(F.col("status")).alias("status"),
        is_truthy(F.get_json_object("metadata", backup_path)).alias("backup"),
    )
    grouped = rows.groupBy("entityId").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max(F.col("status") == "FAILED").alias("had_error"),
        F.min(F.struct("createdAt", "id", "customerId")).alias("first"),
        F.max(F.struct("createdAt", "id", "status", "backup")).alias("last"),
    )
    resolved = F.col("had_error") & (F.col("last.status") == "SUCCESS")
    return grouped.select(
        F.col("first.customerId").alias("customer_id"),
        F.col("entityId").alias("entity_id"),
        "attempts",
        "had_error",
        resolved.alias("resolved"),
        (resolved & F.col("last.backup")).alias("resolved_by_backup"),
        F.col("first.createdAt").alias("first_attempt"),
        F.col("last.createdAt").alias("last_attempt"),
        F.col("last.status").alias("last_status"),
        F.col("last.backup").alias("last_by_backup"),
        F.col("last.id").alias("last_id"),
    )


def payment_recovery_by_card(attempts: DataFrame) -> DataFrame:
    """Per (customer email, description): recovered at all, and on another card than the failed one.

    ``attempts``: description, customer_email, status, created_utc, card_id. Cards
    are folded first, so a busy payment is spread over its cards.
    """
    rows = attempts.filter(F.col("customer_email").isNotNull() & F.col("description").isNotNull()).select(
        "customer_email",
        "description",
        "created_utc",
        F.lower(normalized_status(F.col("status"))).alias("status"),
        F.coalesce(F.col("card_id").cast("string"), F.lit("nan")).alias("card"),
    )
    per_card = rows.groupBy("customer_email", "description", "card").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max(F.col("status") == "failed").alias("failed"),
        F.max(F.when(F.col("status") == "paid", F.col("created_utc"))).alias("paid_at"),
        F.max(F.struct("created_utc", "status")).alias("last"),
        F.min("created_utc").alias("first_at"),
    )
    failed_card = F.when(F.col("failed"), F.col("card"))
    grouped = per_card.groupBy("customer_email", "description").agg(
        F.sum("attempts").alias("attempts"),
        F.max("failed").alias("had_error"),
        F.max("last").alias("last"),
        F.min("first_at").alias("first_attempt"),
        F.count(failed_card).alias("failed_cards"),
        F.min(failed_card).alias("failed_card"),
        F.collect_list(failed_card).alias("failed_ids"),
        F.max(F.when(F.col("paid_at").isNotNull(), F.struct("paid_at", "card"))).alias("paid"),
    )
    resolved = F.col("had_error") & (F.col("last.status") == "paid")
    by_backup = resolved & (F.col("failed_cards") == 1) & (F.col("paid.card") != F.col("failed_card"))
    return grouped.select(
        "customer_email",
        "description",
        "attempts",
        "had_error",
        resolved.alias("resolved"),
        F.coalesce(by_backup, F.lit(False)).alias("resolved_by_backup"),
        F.concat(F.lit("{"), F.array_join(F.array_sort("failed_ids"), ", "), F.lit("}")).alias("failed_card_ids"),
        F.coalesce(F.col("paid.card"), F.lit("(none)")).alias("paid_card_id"),
        "first_attempt",
        F.col("last.created_utc").alias("last_attempt"),
    )


def recovery_summary(detail: DataFrame, error_share_of_all: bool = False) -> DataFrame:
    """The seven summary lines of a recovery table.

    The error share repeats resolved/errors in the entity report and is
    errors/all in the card report (``error_share_of_all=True``).
    """
    totals = detail.agg(
        F.count(F.lit(1)).alias("payments"),
        F.count_if("had_error").alias("errors"),
        F.count_if("resolved").alias("resolved"),
        F.count_if("resolved_by_backup").alias("by_backup"),
    )
    error_share = ("errors", "payments") if error_share_of_all else ("resolved", "errors")
    return metric_rows(
        totals,
        {
            "total_payments": F.col("payments"),
            "total_errors": F.col("errors"),
            "total_resolved": F.col("resolved"),
            "total_resolved_by_backup": F.col("by_backup"),
            "error_share": safe_ratio(F.col(error_share[0]), F.col(error_share[1])),
            "resolved_share": safe_ratio(F.col("resolved"), F.col("errors")),
            "backup_share": safe_ratio(F.col("by_backup"), F.col("resolved")),
        },
    )


def with_device(blocked: DataFrame) -> DataFrame:
    """Blocked payments with ``device``: their own, else that of the customer's first row.

    The customer's first row defines the fallback: its device, or an id made
    from its payment intent. Only rows without a device need the look-up.
    """
    own = blocked.withColumn("_own", word_after(F.col("description"), "device_id:")).withColumn(
        "_made", F.concat(F.lit("user_"), F.col("payment_intent_id"))
    )
    first = own.groupBy("customer_id").agg(
        F.min(F.struct("row_no", F.coalesce("_own", "_made").alias("device")))["device"].alias("_first")
    )
    # Rows with a device look nothing up: their part of the key matches none and spreads them.
    looks_up = F.when(F.col("_own").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("row_no"), F.lit(1000))).cast("int")
    found = own.withColumn("_part", looks_up).join(first.withColumn("_part", F.lit(0)), ["customer_id", "_part"], "left")
    # Rows without a customer share nothing and keep their made-up id.
    return found.withColumn("device", F.coalesce("_own", "_first", "_made")).drop("_own", "_made", "_first", "_part")


def blocked_payments_daily(
    blocked: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    sales_orders: DataFrame,
    orders: DataFrame,
    only_listed_days: bool = False,
) -> DataFrame:
    """Blocked payments per day: amounts, users, what was recovered, and the share of new users.

    ``blocked``: customer_id, payment_intent_id, description, amount,
    rule_decision_created, row_no (file order). ``payments``: description,
    status, amount, row_no. A blocked user is new if the device is no e-mail
    address, or none of a customer, or of a customer without an order more than
    a day before the first block. ``only_listed_days`` counts the last kind only
    on days that have one of the other kinds.
    """
    settled = (
        payments.filter(F.col("status") == "Paid")
        .groupBy(first_word(F.col("description")).alias("initial_id"))
        .agg(F.min_by("amount", "row_no").alias("paid_amount"), F.lit(True).alias("is_resolved"))
    )
    rows = (
        with_device(blocked)
        .withColumn("day", day_of(F.col("rule_decision_created")))
        .withColumn("initial_id", first_word(F.col("description")))
        .join(settled, "initial_id", "left")
        .withColumn("is_resolved", F.coalesce("is_resolved", F.lit(False)))
    )

    # Each row counts for its intent and its device on the day, and for its device over all days:
    # the three groupings are one fold over tagged keys.
    no_day = F.lit(None).cast("date")
    tags = F.array(
        F.struct(F.lit("intent").alias("kind"), F.col("day").alias("on"), F.col("payment_intent_id").alias("key")),
        F.struct(F.lit("user").alias("kind"), F.col("day").alias("on"), F.col("device").alias("key")),
        F.struct(F.lit("device").alias("kind"), no_day.alias("on"), F.col("device").alias("key")),
    )
    measured = ["row_no", "amount", "is_resolved", "paid_amount", "rule_decision_created"]
    folded = (
        rows.select(*measured, F.inline(tags))
        .groupBy("kind", "on", "key")
        .agg(
            F.min_by("amount", "row_no").alias("amount"),
            F.max("is_resolved").alias("is_resolved"),
            F.min_by("paid_amount", F.when(F.col("is_resolved"), F.col("row_no"))).alias("paid_amount"),
            F.min_by("rule_decision_created", "row_no").alias("first_block"),
        )
    )
    accounts = customers.filter(F.col("email").isNotNull()).groupBy(F.col("email").alias("key")).agg(F.min("id").alias("customer"))
    first_order = sales_orders.groupBy(F.col("customerId").alias("customer")).agg(F.min("createdAt").alias("first_order"))
    known = accounts.join(first_order, "customer", "left").withColumn("kind", F.lit("device"))
    is_email = F.coalesce(F.col("key").contains("@"), F.lit(False))
    late = ~F.coalesce(F.col("first_order") < F.col("first_block") - F.expr("interval 1 day"), F.lit(False))
    intent, user, device = (F.col("kind") == k for k in ("intent", "user", "device"))
    per_day = (
        folded.join(known, ["kind", "key"], "left")
        .groupBy(F.when(device, day_of(F.col("first_block"))).otherwise(F.col("on")).alias("day"))
        .agg(
            F.count_if(intent & F.col("key").isNotNull()).alias("blocked_payments"),
            F.sum(F.when(intent, F.col("amount"))).alias("amount_blocked"),
            F.count_if(intent & F.col("is_resolved")).alias("payments_resolved"),
            F.sum(F.when(intent, F.col("paid_amount"))).alias("amount_resolved"),
            F.count_if(user & F.col("key").isNotNull()).alias("blocked_users"),
            F.count_if(user & F.col("is_resolved")).alias("users_resolved"),
            F.count_if(device & (~is_email | F.col("customer").isNull())).alias("outsiders"),
            F.count_if(device & is_email & F.col("customer").isNotNull() & late).alias("late"),
        )
    )
    counted = F.col("outsiders") + F.col("late")
    if only_listed_days:
        counted = F.when(F.col("outsiders") > 0, counted).otherwise(F.lit(0))
    per_day = per_day.withColumn("new_users_blocked", counted).drop("outsiders", "late")
    new_orders = (
        orders.filter(F.col("is_first_order") == 1)
        .groupBy(day_of(F.col("created_at")).alias("day"))
        .agg(F.count(F.lit(1)).alias("total_new_users"))
    )

    # The parts are one row per day, so they are stacked and folded rather than joined.
    measures = [
        "blocked_payments",
        "amount_blocked",
        "blocked_users",
        "payments_resolved",
        "amount_resolved",
        "users_resolved",
        "new_users_blocked",
        "total_new_users",
    ]
    stacked = per_day.unionByName(new_orders, allowMissingColumns=True)
    daily = (
        stacked.groupBy("day")
        .agg(
            *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures],
            F.count("blocked_payments").alias("_listed"),
        )
        .filter("_listed > 0")
        .withColumn("new_users_resolved", F.least("new_users_blocked", "users_resolved"))
    )
    table = with_totals(daily, [*measures, "new_users_resolved"])
    base = F.col("total_new_users") + F.col("new_users_blocked") - F.col("new_users_resolved")
    share = percent(F.col("new_users_blocked"), base)
    return table.withColumn(
        "new_users_blocked_pct", F.when(F.col("row_type") == "day", F.round(share, 2)).otherwise(share)
    )
