"""Reports on hand-built rows: the corners the generated tables do not reach."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

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

ORDERS = (
    "id int, order_number string, customer_id int, subscription_id int, created_at timestamp_ntz, status string, "
    "order_plan string, recurrent int, is_first_order int, units int, total decimal(18,2)"
)
ITEMS = "salesOrderId int, itemId string, category string, quantity int"


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1, hours=hour)


def order(i, day, customer=1, status="PAID", plan="SUBSCRIPTION", recurrent=0, first=0, units=3, total="10.00", hour=0):
    return (i, f"N{i}", customer, customer, at(day, hour), status, plan, recurrent, first, units, total and Decimal(total))


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- orders -------------------------------------------------------------------


def test_valid_items_only_change_with_an_excluded_line(spark):
    o = frame(spark, [order(1, 1), order(2, 1)], ORDERS)
    i = frame(spark, [(1, "X", "c", 1), (1, "Y", "c", 2), (1, "X", "c", 1), (2, "Y", "c", 9)], ITEMS)
    out = by(orders.valid_items(o, i, ["X"]), "id")
    assert (out[1].valid_items, out[2].valid_items) == (1, 3)


def test_daily_kpi_fills_days_and_recomputes_totals(spark):
    rows = [
        order(1, 1, first=1, total="10.00"),
        order(2, 3, first=1, plan="OTO", total="30.00"),
        order(3, 3, recurrent=1, total="7.00"),
        order(4, 2, status="CANCELLED"),
        order(5, 4),  # the end is outside
        order(6, 1, first=0, total=None),
    ]
    items = frame(spark, [], ITEMS)
    table = orders.daily_orders_kpi(frame(spark, rows, ORDERS), items, "2024-01-01", "2024-01-04", ["X"])
    out = by(table, "segment", "label")
    assert len(out) == 9 * 4
    assert out["new_all", "2024-01-02"].orders == 0 and out["new_all", "2024-01-02"].avg_value == 0
    assert out["new_all", "Total"].revenue == 40 and out["new_all", "Total"].avg_value == 20
    assert out["new_oto", "2024-01-03"].orders == 1
    assert out["recurrent", "Total"].revenue == 7
    # The total row counts priced orders only.
    assert out["existing_all", "2024-01-01"].orders == 1 and out["existing_all", "Total"].orders == 0


def test_sales_split_lists_only_days_that_occur(spark):
    rows = [order(1, 1), order(2, 1, recurrent=1), order(3, 5, recurrent=1), order(4, 5, first=1)]
    out = by(orders.daily_sales_split(frame(spark, rows, ORDERS), "2024-01-01", "2024-02-01"), "label")
    assert set(out) == {"2024-01-01", "2024-01-05", "Total", "Mean"}
    assert out["Mean"].daily_no_recurrent == 0.5 and out["Total"].daily_recurrent == 2


def test_expected_renewals_include_the_end(spark):
    subs = frame(
        spark,
        [
            (1, at(1), "ACTIVE", '{"frequency":"Every 2 weeks"}'),  # due on the 15th, the end
            (2, at(1), "ACTIVE", '{"frequency":"Every 3 weeks"}'),  # after it
            (3, at(1), "ON_HOLD", '{"frequency":"Every 1 weeks"}'),
            (4, at(1), "ACTIVE", "bad"),
        ],
        "id int, updatedAt timestamp_ntz, status string, additionalFields string",
    )
    o = frame(spark, [order(1, 3, recurrent=1, units=1), order(2, 3, recurrent=1, units=2)], ORDERS)
    out = by(orders.expected_vs_obtained_renewals(subs, o, "2024-01-01", "2024-01-15"), "label")
    assert (out["2024-01-15"].expected, out["2024-01-03"].obtained) == (1, 1)
    assert out["2024-01-03"].ratio == 0 and out["Total"].ratio == 1


# --- payments -----------------------------------------------------------------

PAY = "id int, entityId string, customerId int, createdAt timestamp_ntz, status string, metadata string"


def test_payment_outcomes(spark):
    rows = [
        (1, "late", 1, at(2), "FAILED", "{}"),
        (2, "late", 1, at(3), "SUCCESS", None),
        (3, "early", 1, at(2), "SUCCESS", None),  # success before the failure still resolves
        (4, "early", 1, at(4), "FAILED", None),
        (5, "fine", 1, at(2), "SUCCESS", None),
        (6, "stuck", 1, at(2), "FAILED", None),
        (7, None, 1, at(2), "FAILED", None),
    ]
    out = by(payments.payment_outcomes(frame(spark, rows, PAY), "2024-01-01", "2024-02-01"), "entityId")
    assert set(out) == {"late", "early", "fine", "stuck"}
    assert (out["late"].first_error_date, out["late"].resolved_date) == (dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert (out["early"].first_error_date, out["early"].resolved_date) == (None, dt.date(2024, 1, 2))
    assert (out["fine"].first_error_date, out["fine"].resolved_date) == (None, None)
    reasons = payments.payment_error_reasons(frame(spark, rows, PAY), "2024-01-01", "2024-02-01")
    assert {tuple(r) for r in reasons.collect()} == {("unknown_error", 1), ("invalid_metadata", 1)}


def test_look_back_keeps_earlier_first_errors_out_of_the_days(spark):
    rows = [(1, "a", 1, dt.datetime(2023, 12, 20), "FAILED", None), (2, "a", 1, at(5), "SUCCESS", None)]
    out = by(payments.payment_error_daily(frame(spark, rows, PAY), "2024-01-01", "2024-02-01"), "label")
    assert (out["2024-01-05"].daily_errors, out["2024-01-05"].daily_resolved) == (0, 1)
    assert payments._months_back("2024-03-31", 1) == "2024-02-29"
    assert payments._months_back("2024-01-15", 1) == "2023-12-15"


def test_recovery_looks_at_the_last_attempt(spark):
    rows = [
        (1, "a", 1, at(1), "failed ", None),
        (2, "a", 2, at(2), "success", '{"isBackupPayment":true}'),
        (3, "b", 1, at(2), "SUCCESS", '{"isBackupPayment":true}'),
        (4, "b", 1, at(3), "FAILED", None),
    ]
    detail = payments.payment_recovery(frame(spark, rows, PAY), "2024-01-01", "2024-02-01")
    out = by(detail, "entity_id")
    assert out["a"].resolved and out["a"].resolved_by_backup and out["a"].customer_id == 1
    assert out["b"].had_error and not out["b"].resolved
    summary = {r.metric: r.value for r in payments.recovery_summary(detail).collect()}
    assert summary["error_share"] == summary["resolved_share"] == 0.5 and summary["backup_share"] == 1


def test_recovery_by_card_needs_one_failed_card(spark):
    rows = [
        ("p", "a", "Failed", at(1), "c1"),
        ("p", "a", "Paid", at(2), "c2"),
        ("p", "b", "Failed", at(1), "c1"),
        ("p", "b", "Failed", at(2), "c2"),
        ("p", "b", "Paid", at(3), "c3"),
        ("p", "c", "Failed", at(1), "c1"),
        ("p", "c", "Paid", at(2), "c1"),
        ("p", "d", "Failed", at(1), None),
        (None, "e", "Failed", at(1), "c1"),
    ]
    table = frame(spark, rows, "description string, customer_email string, status string, created_utc timestamp_ntz, card_id string")
    out = by(payments.payment_recovery_by_card(table), "customer_email")
    assert {k: v.resolved_by_backup for k, v in out.items()} == {"a": True, "b": False, "c": False, "d": False}
    assert out["b"].failed_card_ids == "{c1, c2}" and out["d"].failed_card_ids == "{nan}"
    assert out["d"].paid_card_id == "(none)" and out["b"].paid_card_id == "c3"


BLOCKED = "customer_id string, payment_intent_id string, description string, amount double, rule_decision_created timestamp_ntz, row_no int"


def test_blocked_payments(spark):
    blocked = frame(
        spark,
        [
            ("u1", "p1", "o1 text", 10.0, at(1), 1),  # no device: made from the intent
            ("u1", "p2", "o2 device_id:a@example.com", 20.0, at(1), 2),
            ("u2", "p3", "o3 device_id:b@example.com", 5.0, at(2), 3),
            ("u2", "p3", "o3", 7.0, at(2), 4),  # takes b@, and is the same intent
            ("u3", "p4", "o4 device_id:c@example.com", 1.0, at(2), 5),
        ],
        BLOCKED,
    )
    paid = frame(
        spark,
        [("o3 x", "Failed", 1.0, 1), ("o3 x", "Paid", 4.0, 2), ("o3 x", "Paid", 9.0, 3)],
        "description string, status string, amount double, row_no int",
    )
    people = frame(spark, [(2, "b@example.com"), (3, "c@example.com"), (4, None)], "id int, email string")
    sales = frame(spark, [(2, at(-5)), (3, at(2))], "customerId int, createdAt timestamp_ntz")
    first = frame(spark, [(at(2), 1)], "created_at timestamp_ntz, is_first_order int")
    devices = by(payments.with_device(blocked), "row_no")
    assert [devices[i].device for i in (1, 2, 4)] == ["user_p1", "a@example.com", "b@example.com"]
    out = by(payments.blocked_payments_daily(blocked, paid, people, sales, first), "label")
    one, two = out["2024-01-01"], out["2024-01-02"]
    assert (one.blocked_payments, one.amount_blocked, one.blocked_users, one.new_users_blocked) == (2, 30, 2, 2)
    assert (two.blocked_payments, two.amount_blocked, two.payments_resolved, two.amount_resolved) == (2, 6, 1, 4)
    assert (two.new_users_blocked, two.new_users_resolved, two.new_users_blocked_pct) == (1, 1, 100)
    assert out["Total"].new_users_blocked == 3
    strict = by(payments.blocked_payments_daily(blocked, paid, people, sales, first, only_listed_days=True), "label")
    assert strict["2024-01-02"].new_users_blocked == 0


# --- subscriptions and program ------------------------------------------------


def test_mini_subscriptions_count_first_orders_and_regular_ones_themselves(spark):
    subs = frame(
        spark,
        [(1, "m", "ACTIVE", at(1)), (2, "r", "ACTIVE", at(1)), (3, "m", "CANCELLED", at(1)), (4, "x", "ACTIVE", at(1))],
        "id int, plan_id string, status string, created_at timestamp_ntz",
    )
    o = frame(spark, [order(i, 1, customer=c, first=1) for i, c in ((1, 1), (2, 1), (3, 2), (4, 2))], ORDERS)
    i = frame(spark, [], ITEMS)
    out = {r.metric: r.value for r in subscriptions.subscription_mix(subs, o, i, "2024-01-01", "2024-02-01", ["m"], ["r"], ["X"]).collect()}
    assert (out["mini_subscriptions"], out["new_mini_subscriptions"], out["existing_mini_subscriptions"]) == (1, 2, -1)
    assert (out["subscriptions"], out["new_subscriptions"], out["mini_pct"], out["oto_pct"]) == (1, 1, 50, 0)


def test_refill_takes_one_line_per_order(spark):
    o = frame(spark, [order(1, 2, first=1, plan="OTO"), order(2, 2, customer=9)], ORDERS)
    people = frame(spark, [(1,)], "id int")
    i = frame(spark, [(1, "B", "r", 5), (1, "A", "r", 2), (1, "C", "o", 1), (2, "A", "r", 8)], ITEMS)
    out = {r.metric: r.value for r in subscriptions.category_refill(o, people, i, "2024-01-01", "2024-02-01", ["r"], ["o"]).collect()}
    assert out == {"refill_orders": 1, "refill_new_customers": 1, "refill_units": 2, "oto_orders": 1, "oto_new_customers": 1}


def test_survey_bounds_differ(spark):
    o = frame(spark, [order(1, 1, first=1), order(2, 32, first=1)], ORDERS)
    a = frame(spark, [(1, 1, "A", at(1)), (2, 1, "A", at(2)), (3, 1, "B", at(2))], "id int, customerId int, source string, createdAt timestamp_ntz")
    out = {r.metric: r.value for r in subscriptions.acquisition_survey(o, a, "2024-01-01", "2024-02-01", ["A"]).collect()}
    assert out == {"new_customer_orders": 2, "respondents": 1, "source:A": 1}


ENROLL = "subscription_id int, first_date timestamp_ntz, last_date timestamp_ntz"
RENEW = "id string, subscriptionId int, createdAt timestamp_ntz, status string"
SUBS = "id int, customerId int, status string, sms_renewal int, additionalFields string, createdAt timestamp_ntz"


def program_base(spark):
    enroll = frame(spark, [(1, at(2, 12), at(20)), (2, at(2, 12), None), (3, at(2, 12), None)], ENROLL)
    subs = frame(spark, [(i, i, "ACTIVE", 1, '{"sms_renewal":"true"}', at(1)) for i in (1, 2, 3)], SUBS)
    renew = frame(
        spark,
        [
            ("a", 1, at(2, 9), "SUCCESS"),  # same day, before the moment: counts by date
            ("b", 1, at(20, 12), "SUCCESS"),  # last day counts
            ("c", 1, at(21), "SUCCESS"),
            ("d", 2, at(9), "SUCCESS"),
            ("e", 2, at(8), "FAILED"),
            ("f", 3, at(1), "SUCCESS"),  # before enrolment
        ],
        RENEW,
    )
    return enroll, subs, renew


def test_program_rows_flags_and_tables(spark):
    enroll, subs, renew = program_base(spark)
    flags = program.program_flags(program.program_enrollment_base(enroll, subs, renew, "2023-01-01"))
    out = by(flags, "subscription_id", "renewal_id")
    assert set(out) == {(1, "a"), (1, "b"), (2, "d"), (3, None)}
    assert (out[1, "a"].same_day_reactivation, out[1, "b"].renewal_number, out[3, None].renewal_number) == (1, 2, 0)
    assert out[1, "b"].reactivated_subscription_id == 1 and out[2, "d"].reactivated_subscription_id is None
    assert [out[k].unique_subscription for k in ((1, "a"), (1, "b"), (3, None))] == [1, 0, 1]
    count = lambda name: {r.month_number: r["count"] for r in program.program_count_table(flags, name).collect()}
    assert count("customers_joined") == {1: 3} and count("no_renewals_yet") == {1: 1}
    assert count("same_day_and_again") == {1: 1} and count("first_renewal_not_reactivation") == {1: 1}
    tracked = by(program.program_tracker(flags, "2023-12-01", "2024-02-01"), "month", "metric")
    assert len(tracked) == 3 * 10
    assert tracked[dt.date(2024, 1, 1), "customers_joined"].value == 3
    assert tracked[dt.date(2023, 12, 1), "all_renewals"].value == 0
    assert tracked[dt.date(2024, 1, 1), "active_processing_onhold"].value == 3
    statuses = program.program_status_table(flags, "active_processing").collect()
    assert [(r.ACTIVE, r.PROCESSING, r.total) for r in statuses] == [(3, 0, 3)]


def test_program_snapshot_counts_members_not_renewals(spark):
    enroll, subs, renew = program_base(spark)
    out = {r.metric: r.value for r in program.program_snapshot(subs, enroll, renew, "2024-01-01", "2024-02-01").collect()}
    assert out == {"members": 3, "new_members": 3, "renewed_members": 1, "new_members_pct": 100}


def test_monthly_table_reads_lenient_dates(spark):
    df = frame(spark, [("2024-01-05", 1), ("45292", 1), ("x", 1), (None, 1), ("2024-03-01", None)], "d string, v int")
    out = {r.month: r.n for r in program.monthly_count_table(df, "d", "v", "n").collect()}
    assert out == {"ene": 2}
    with pytest.raises(ValueError):
        program.monthly_count_table(df, "d", "v", "n", {"missing": 1})


# --- renewals -----------------------------------------------------------------


def test_gap_counts_elapsed_days_and_cohorts(spark):
    o = frame(spark, [order(1, 1, hour=23), order(2, 3, hour=1), order(3, 2, customer=2)], ORDERS)
    subs = frame(spark, [(1, 1, "ACTIVE", 1, '{"sms_renewal":"true"}', at(1)), (2, 2, "ACTIVE", 0, "{}", at(1))], SUBS)
    view = frame(spark, [(1, "A", "14 days"), (2, "A", "7 days")], "subscription_id int, legacy_category string, delivery_frequency string")
    gaps = renewals.renewal_gap_simple(o, subs, view, "2023-01-01", "2025-01-01")
    assert {(r.cohort, r.subscription_id, r.days_between_orders, r.frequency_weeks) for r in gaps.collect()} == {
        ("program", 1, 1, 2.0),
        ("all", 1, 1, 2.0),
    }
    table = by(renewals.renewal_gap_comparison(gaps, ["A", "B"]), "cohort", "series")
    assert table["all", "A"].avg_days == 1 and table["all", "B"].mode_weeks == "0.00"


def test_modes_show_three_of_the_tied_values(spark):
    rows = [("all", i, d, d / 7.0, None, "A") for i, d in enumerate([7, 7, 3, 3, 9, 9, 1, 1, 5])]
    gaps = frame(spark, rows, "cohort string, subscription_id int, days_between_orders int, weeks_between_orders double, frequency_weeks double, category string")
    out = by(renewals.renewal_gap_comparison(gaps, ["A"]), "series")
    assert out["actual"].mode_days == "1.00, 3.00, 7.00" and out["configured"].mode_days == "No data"


def test_frequency_changes_use_the_last_date_of_each(spark):
    renew = frame(spark, [(f"RE{i}", 1, at(i), "SUCCESS") for i in range(1, 7)] + [("RE9", 2, at(1), "SUCCESS")], RENEW)
    texts = ["Every 2 weeks", "Every 2 weeks", "Every 4 weeks", "Every 1 months", "Every 2 weeks", "Every 3 weeks"]
    rows = [(f"RE{i}", f"Sub ({t})", at(i)) for i, t in enumerate(texts, 1)]
    rows += [("RE9", "Sub (Every 2 weeks)", at(1)), ("XX1", "Sub (Every 5 weeks)", at(1)), ("RE1", "Fee (Every 9 weeks)", at(1))]
    fees = frame(spark, rows, "entityId string, description string, createdAt timestamp_ntz")
    changes = renewals.frequency_changes(fees, renew)
    assert [r.changed_at.day for r in changes.orderBy("changed_at").collect()] == [1, 3, 4, 5, 6]
    window = lambda a, b: frame(spark, [(1, at(b), at(a))], "subscription_id int, last_ts timestamp_ntz, second_last_ts timestamp_ntz")
    summary = lambda a, b: [r.frequency_change_weeks for r in renewals.frequency_change_summary(changes, window(a, b)).collect()]
    assert summary(5, 6) == [1]  # from every 2 (seen last on the 5th) to every 3 weeks
    assert summary(1, 2) == []  # the first change moved to its last date


def test_payment_errors_need_two_orders_and_include_both_ends(spark):
    o = frame(spark, [order(1, 1), order(2, 5), order(3, 5, customer=2)], ORDERS)
    renew = frame(spark, [("RE1", 1, at(1), "x"), ("RE2", 2, at(1), "x"), ("XX3", 1, at(1), "x")], RENEW)
    rows = [("RE1", at(1)), ("RE1", at(5)), ("RE1", at(6)), ("RE2", at(5)), ("XX3", at(2)), ("XX3", at(2))]
    out = renewals.renewal_payment_errors(o, renew, frame(spark, rows, "entityId string, createdAt timestamp_ntz")).collect()
    assert [tuple(r) for r in out] == [(1, 1)]


# --- funnels ------------------------------------------------------------------


def test_funnel_shares(spark):
    wide = frame(spark, [(1, 10, 5, 0, 9), (2, 0, 3, 0, 9)], "Day int, `1. View` int, `2. Cart` int, `3. Buy` int, `Ingreso Active users` int")
    steps = funnel.funnel_steps(wide, "shop")
    assert {(r.step_no, r.step) for r in steps.collect()} == {(1, "View"), (2, "Cart"), (3, "Buy")}
    out = by(funnel.funnel_daily(steps), "label", "step")
    assert (out["1", "Cart"].pct_of_first, out["1", "View"].pct_of_first) == (50, None)
    assert out["2", "Cart"].pct_of_previous is None  # something over nothing
    assert out["1", "Buy"].pct_of_previous == 0 and out["Total", "Cart"].pct_of_first == 80
    assert by(funnel.funnel_summary(steps), "step")["View"].users == 10


# --- repurchase and cohorts ---------------------------------------------------


def test_products_and_bundles(spark):
    rows = [order(1, 1, first=1, plan="OTO"), order(2, 9, plan="OTO"), order(3, 9, customer=2, plan="OTO"), order(4, 9, plan="OTO")]
    i = frame(spark, [(1, "x", "c", 1), (1, "y", "c", 1), (2, "x", "c", 1), (2, "z", "c", 1), (3, "x", "c", 1), (4, "x", "d", 1)], ITEMS)
    names = frame(spark, [("x", "X"), ("y", "Y"), ("z", "Y")], "itemId string, product_name string")
    tables = (frame(spark, rows, ORDERS), i, names)
    bought = repurchase.product_purchases(*tables, "2024-01-01", "2024-01-05", "c")
    out = by(repurchase.product_repurchase(bought), "product_name")
    assert {k: (v.users, v.repurchasers, v.orders, v.repurchase_pct) for k, v in out.items()} == {"X": (1, 1, 2, 100), "Y": (1, 1, 2, 100)}
    bundles = repurchase.bundle_repurchase(*tables, "2024-01-01", "2024-01-05", "c", [["Y", "X"], ["X", "Q"]]).collect()
    assert [(r.combination, r.orders) for r in bundles] == [("X + Y", 2)]


def test_answers_by_label(spark):
    cohort = frame(
        spark,
        [
            (1, 1, '{"values":[{"variable":4,"value":33},{"variable":27,"value":"Ann"}]}', 2, ["d"]),
            (2, 2, '{"values":{"k":{"variable":"4","value":"40"}}}', 1, []),
            (3, 3, '[{"variable":99,"value":"odd"}]', 1, []),
            (4, 4, None, 3, []),
        ],
        "order_id int, customer_id int, diagnostic string, total_custom_orders int, tracked_items array<string>",
    )
    labelled = repurchase.labelled_answers(cohort, {4: "COLOR"}, {33: "BLACK", 40: "BLACK"})
    out = by(repurchase.repurchase_by_answer(labelled, (27,)), "variable", "value")
    assert (out["COLOR", "BLACK"].repurchased, out["COLOR", "BLACK"].total) == (1, 2)  # equal labels merge
    assert out["VARIABLE_99", "odd"].total == 1 and len(out) == 2
    only = repurchase.repurchase_by_answer(labelled, (27,), tracked_item="d").collect()
    assert [(r.variable, r.total) for r in only] == [("COLOR", 1)]
    combos = repurchase.repurchase_by_combination(labelled, {"a": [("COLOR", "BLACK"), ("VARIABLE_27", "Ann")], "b": [("COLOR", "RED")]})
    assert [(r.combination, r.repurchased, r.total) for r in combos.collect()] == [("a", 1, 1)]


def test_cohorts_of_overlapping_periods_in_one_pass(spark):
    rows = [order(1, 1, first=1), order(2, 4), order(3, 9), order(4, 4, customer=2, first=1), order(5, 8, customer=3, first=1), order(6, 3, customer=3)]
    items = frame(spark, [(n, "x", "c", 1) for n in range(1, 7)], ITEMS)
    raw = frame(spark, [(1, "x", '{"diagnostic":[{"variable":4,"value":1}]}')], "salesOrderId int, itemId string, additionalFields string")
    periods = {"early": ("2024-01-01", "2024-01-05"), "late": ("2024-01-04", "2024-01-09"), "none": ("2020-01-01", "2020-02-01")}
    args = ("2024-01-09", "c", ["c"], ["x"])
    tables = (frame(spark, rows, ORDERS), items, raw)
    every = repurchase.first_order_cohorts(*tables, periods, *args)
    found = sorted((r.period, *r[1:3], r.total_custom_orders) for r in every.collect())
    alone = [
        (name, r.order_id, r.customer_id, r.total_custom_orders)
        for name, (start, end) in periods.items()
        for r in repurchase.first_order_cohort(*tables, start, end, *args).collect()
    ]
    assert found == sorted(alone) and {f[0] for f in found} == {"early", "late"}
    # The order in both periods counts its customer's orders from either start.
    assert {(f[0], f[1]) for f in found if f[1] == 4} == {("early", 4), ("late", 4)}
    empty = repurchase.first_order_cohorts(tables[0].limit(0), *tables[1:], periods, *args)
    assert empty.count() == 0


def test_period_table_fills_and_shares(spark):
    rows = [("p", "V", "a", 1, 3, 4, 25.0), ("p", "V", "b", 0, 1, 1, 0.0), ("q", "V", "a", 2, 0, 2, 100.0)]
    tables = frame(spark, rows, "period string, variable string, value string, repurchased long, not_repurchased long, total long, repurchase_pct double")
    out = by(repurchase.repurchase_period_table(tables, ["p", "q"]), "period", "value")
    assert len(out) == 4 and out["q", "b"].total == 0 and out["q", "b"].pct_of_variable == 0
    assert (out["p", "b"].pct_of_max, out["p", "b"].pct_of_variable) == (25, 20)


def test_cohort_activity(spark):
    rows = [
        order(1, 1, total="10.00"),
        order(2, 1, total="30.00"),  # same moment: the dearer one opens
        order(3, 9, plan="OTO", total="5.00"),
        order(4, 1, customer=2),
        order(5, -500, customer=3),
    ]
    people = frame(spark, [(1,), (2,), (3,)], "id int")
    subs = frame(spark, [(1, 1, "CANCELLED", 1, "{}", at(1)), (2, 2, "CANCELLED", 1, "{}", at(1))], SUBS)
    gone = frame(spark, [(7, 2, "x", at(2))], "id int, subscriptionId int, reason string, createdAt timestamp_ntz")
    raw = frame(spark, [], "salesOrderId int, itemId string, additionalFields string")
    whole = frame(spark, [(1, '{"diagnostic":[{"variable":36,"value":114}]}')], "id int, additionalFields string")
    o = frame(spark, rows, ORDERS)
    latest = cohorts.last_one_time_order(o)
    facts = cohorts.subscriber_facts(
        o, people, subs, gone, raw, whole, "2024-01-01", "2024-12-31", "%k%", {"never": ["114"]}, (40, 36), latest
    )
    out = by(cohorts.with_activity(facts), "customer_id")
    assert set(out) == {1, 2}
    assert (out[1].orders, out[1].revenue, out[1].repurchase_revenue, out[1].experience) == (3, 45, 15, "never")
    assert out[1].is_active and out[2].is_active  # by a one-time order, by a recent cancellation
    table = by(cohorts.investor_cohorts(cohorts.with_activity(facts), "2023-12-01", "2024-01-01", ["never"]), "split", "cohort_month")
    assert len(table) == 4
    assert table["all", dt.date(2024, 1, 1)].new_users == 2 and table["never", dt.date(2024, 1, 1)].repurchase_orders == 2
    assert table["never", dt.date(2023, 12, 1)].revenue == 0


# --- cancellations ------------------------------------------------------------

CANCEL = "id int, subscriptionId int, reason string, createdAt timestamp_ntz"


def cancelled(spark, dedupe=True):
    o = frame(spark, [order(1, 1), order(2, 3), order(3, 5, status="CANCELLED"), order(4, 9), order(5, 2, customer=2)], ORDERS)
    i = frame(spark, [(1, "a", "c", 1), (2, "a", "c", 1), (2, "b", "c", 1), (4, "a", "c", 1), (5, "z", "c", 1)], ITEMS)
    kit = '{"diagnostic":[{"variable":4,"value":%d}]}'
    raw = frame(spark, [(2, "k2", kit % 14), (2, "k1", kit % 13)], "salesOrderId int, itemId string, additionalFields string")
    whole = frame(spark, [(1, kit % 15), (2, kit % 15)], "id int, additionalFields string")
    c = frame(spark, [(1, 1, "bad -> x", at(7)), (2, 1, None, at(3)), (3, 2, "bad", at(7)), (4, 1, "bad", at(40))], CANCEL)
    return cancellations.cancellation_base(
        c, o, i, raw, whole, "2024-01-01", "2024-02-01", ["a", "b"], ["k1", "k2"], [13, 14, 15], {"now": ["118"]}, (40, 36), dedupe
    )


def test_cancellation_takes_the_last_valid_order_before(spark):
    out = by(cancelled(spark), "cancel_id")
    assert {k: (v.order_id, v.listed_items, v.segment_code) for k, v in out.items()} == {
        1: (2, ["a", "b"], 13),  # the lower kit id
        2: (1, ["a"], 15),  # an order at the same moment is not before; falls back to the order's answers
    }
    assert sorted(r.segment_code for r in cancelled(spark, dedupe=False).filter("cancel_id = 1").collect()) == [13, 14]


def test_cancellation_tables(spark):
    base = cancelled(spark)
    segments = {"s13": 13, "s15": 15}
    out = by(cancellations.cancel_by_reason_segment(base, segments), "reason")
    assert (out["bad"].cancellations_pct, out["bad"].s13, out["bad"].s13_pct, out["bad"].s15_pct) == (50, 1, 100, 0)
    items = by(cancellations.cancel_by_reason_item(base, ["a", "b"], segments), "segment", "reason", "item_id")
    assert items["all", "bad", "a"].share_pct == 50 and items["s15", list({k[1] for k in items if k[0] == "s15"})[0], "b"].cancellations == 0
    shown = by(cancellations.cancel_by_reason_experience(base, {"now": "now", "unknown": "Unknown"}), "reason")
    assert shown["bad"].unknown_pct == 50 and shown["bad"].now_pct == 0


def test_last_order_of_any_status_keeps_ties(spark):
    o = frame(spark, [order(1, 1), order(2, 3, status="CANCELLED"), order(3, 3)], ORDERS)
    i = frame(spark, [(2, "a", "c", 1), (3, "b", "c", 1), (3, "b", "c", 1), (1, "z", "c", 1)], ITEMS)
    c = frame(spark, [(1, 1, "bad -> x", at(5)), (2, 1, "bad -> x", at(5))], CANCEL)
    subs = frame(spark, [(1, 1, "x", 1, '{"diagnostic":{"values":[{"value":13},{"value":15}]}}', at(1))], SUBS)
    rows = cancellations.cancel_by_last_order(c, o, i, subs, "2024-01-01", "2024-02-01", "c", (14, 15, 13))
    assert sorted((r.order_id, r.item_id, r.segment_code) for r in rows.collect()) == [(2, "a", 15), (3, "b", 15)]
    assert cancellations.cancellation_level(rows).count() == 1
    few = cancellations.cancel_by_last_order(c, o, i, subs, "2024-01-01", "2024-02-01", "c", (14, 15, 13), ["a"])
    assert few.count() == 1
    out = by(cancellations.cancel_by_reason_last_item(rows, ["a", "b"], {"s15": 15}), "segment", "item_id")
    assert out["all", "b"].cancellations == 1 and out["s15", "a"].share_pct == 100


def test_calendars(spark):
    c = frame(spark, [(1, 1, "too dark - x", at(1)), (2, 1, "price", at(2)), (3, 2, "price", at(40))], CANCEL)
    view = frame(spark, [(1, "CANCELLED"), (2, "CANCELLED")], "subscription_id int, status string")
    items = frame(spark, [(1, "a"), (1, "b"), (2, "a")], "subscriptionId int, itemId string")
    names = frame(spark, [("a", "A"), ("b", "B")], "itemId string, product string")
    rows = cancellations.cancel_item_rows(c, view, items, names)
    daily = by(cancellations.cancel_item_daily(rows, ["A", "B"]), "label", "product")
    assert daily["2024-02-09", "B"].cancellations == 0 and daily["Total", "A"].historic_share == 0.6
    monthly = by(cancellations.cancel_item_monthly(rows, ["A", "B"]), "row_type", "month", "product")
    assert monthly["month", 2, "B"].flag == "low" and monthly["month", 2, "A"].flag == "high"
    assert monthly["total", None, "A"].cancellations == 3 and monthly["month", 1, "A"].flag is None
    reasons = by(cancellations.cancel_reason_calendar(c, items, "2023-12-31", "2025-01-01"), "row_type", "month", "reason")
    assert reasons["month", 1, "too dark"].cancellations == 2  # once per item
    assert reasons["mean", None, "price"].share == 0.75 and reasons["total", None, "price"].cancellations == 3
    assert reasons["month", 2, "too dark"].flag == "low"
    only = cancellations.cancel_reason_calendar(c, items, "2023-12-31", "2025-01-01", include_items=["b"])
    assert {r.reason for r in only.collect()} == {"too dark", "price"}


# --- promotions, baskets, reviews, trackers -----------------------------------


def test_promo(spark):
    o = frame(spark, [order(i, d, plan="OTO") for i, d in ((1, 2), (2, 2), (3, 3))] + [order(4, 4, plan="OTO", recurrent=1)], ORDERS)
    d = frame(spark, [(1, "3x2 a", at(2)), (4, "3x2", at(4)), (2, "other", at(2))], "entityId int, name string, createdAt timestamp_ntz")
    daily = promo.promo_daily(d, o, "2024-01-01", "2024-02-01", "3x2")
    out = by(promo.promo_comparison(daily), "day")
    assert {k.day: v.discounted_pct for k, v in out.items()} == {2: 50, 3: 0}  # the 4th has no plain order
    means = {r.metric: r.value for r in promo.promo_means(daily).collect()}
    assert means["orders_per_day"] == 1.5 and means["discounted_per_day"] == 1 and means["discounted_per_month"] == 2
    assert promo.recent_or_all(daily, "orders", "2024-01-03").count() == 1
    assert promo.recent_or_all(daily, "orders", "2025-01-01").count() == 2
    total = by(promo.promo_monthly(promo.promo_comparison(daily)), "month")["TOTAL"]
    assert (total.orders, total.days, total.orders_per_day) == (3, 2, 1.5)


def test_trend(spark):
    points = frame(spark, [(1, 1.0, "a"), (2, 3.0, "a"), (4, 5.0, "a"), (1, 0.0, "z"), (2, 0.0, "z"), (1, 9.0, "one")], "x int, y double, s string")
    out = by(promo.trend_line(points, "x", "y", "s"), "s", "x")
    assert [round(out["a", x].trend, 9) for x in (1, 2, 4)] == [1, 3, 5]
    assert out["z", 1].trend is None and out["one", 1].trend is None


def test_baskets(spark):
    def content(items, discounts="[]", subscribed="false", status="OK"):
        return f'{{"items":{items},"discounts":{discounts},"status":"{status}","additionalFields":{{"subscribed":{subscribed}}}}}'

    paid = '[{"unitPrice":20,"quantity":2},{"unitPrice":0,"quantity":1}]'
    off = '[{"value":3,"additionalFields":{"type":"shipping"}},{"value":5}]'
    rows = [
        ("N1", at(2), content(paid, off)),
        (None, at(4), content(paid)),
        ("N2", at(2), content('[{"unitPrice":0,"quantity":1}]')),  # nothing priced
        ("N3", at(2), content(paid, status="CANCELLED")),
        ("N4", at(2), content(paid, subscribed="true")),
        ("N5", at(2), content('[{"unitPrice":10,"quantity":1}]')),
        ("N6", at(1), content(paid)),  # the start is outside
        ("N7", at(2), "bad"),
    ]
    intents = frame(spark, rows, "orderNumber string, createdAt timestamp_ntz, content string")
    everything = basket.basket_value(intents, "2024-01-01", "2024-01-11")
    assert {r.order_number: (r.total_amount, r.units) for r in everything.filter("not subscribed").collect()} == {
        "N1": (35, 2),
        None: (40, 2),
        "N5": (10, 1),
    }
    kept = basket.basket_value(intents, "2024-01-01", "2024-01-11", basket.FREE_SHIPPING)
    summary = basket.basket_summary(intents, "2024-01-01", "2024-01-11", basket.FREE_SHIPPING)
    out = {(r.subscribed, r.kind, r.metric): r.value for r in summary.collect()}
    assert out[False, "orders", "avg_amount"] == 35 and out[False, "attempts", "conversion"] == 0.5
    assert out[False, "orders", "all_orders_per_day"] == pytest.approx(3 / 11)
    bins = by(basket.basket_histogram(kept), "subscribed", "kind", "label")
    assert bins[False, "orders", "20 - 35"].baskets == 1 and bins[False, "orders", "> 95"].avg_amount is None
    assert bins[False, "attempts", "35 - 50"].share == 1 and bins[True, "orders", "30 - 45"].baskets == 1
    assert by(basket.basket_units(kept), "subscribed", "kind", "units")[False, "orders", 2.0].baskets == 1


FEEDBACK = (
    "title string, feedback struct<adminStatus:string,rating:string,productName:string,sku:string,orderId:string,"
    "title:string,feedBack:string,nameOnAmazon:string,email:string,createdAt:string>"
)


def review(status, rating, name="P", date="2024-01-01T00:00:00Z"):
    return ("item", (status, rating, name, "k1", "o", "t", "fine", "Ann Lee", "user1@example.com", date))


def test_reviews(spark):
    rows = [review("verified", "5"), review("NOT_VERIFIED", "4", None), review("PENDING", "5"), review("VERIFIED", "3"), review("VERIFIED", None), review(None, "5")]
    df = frame(spark, rows, FEEDBACK)
    out = by(reviews.verified_reviews(df), "overallrating")
    assert {k: (v.product, v.recommendation) for k, v in out.items()} == {5: ("P", 10), 4: ("item", 8)}
    assert {r.metric: r.value for r in reviews.verified_reviews_summary(df).collect()} == {"reviews": 6, "verified_reviews": 2}


def test_review_load(spark):
    rows = [("k1", "4.0", "2024-01-01T00:00:00Z", " hi ", "Ann Lee", None), ("zz", "x", "never", "", " ", "[1]")]
    df = frame(spark, rows, "sku string, overallrating string, date string, headline string, nickname string, pros string")
    build = lambda: reviews.review_load_set(df, [{"type": 12, "codes": ["K1"]}], {"K1": "a.jpg"}, "https://img.example.com/", "me")
    out = by(build(), "overall_rating")
    assert out[4].product_review_type_id == "PRT" + "0" * 27 + "12" and out[None].product_review_type_id.endswith("01")
    assert (out[4].headline, out[4].nickname, out[4].pros, out[None].pros) == ("hi", "Ann", "a:0:{}", "[1]")
    assert out[4].additional_fields == '{"mainImage": "https://img.example.com/a.jpg"}' and out[None].headline is None
    assert {r.id for r in build().collect()} == {r.id for r in out.values()} and len({r.id for r in out.values()}) == 2
    assert [r.problem for r in reviews.review_load_errors(build()).collect()] == ["date"]


def test_tracker(spark):
    master = frame(spark, [("Blue ", "bad"), ("Deep-Blue", "bad"), ("Green", "bad")], "item string, reason string")
    source = frame(spark, [(2, "deep blue", "bad ", "7%"), (1, "Deep Blue", "bad", "12,5%"), (3, "BLUE", "bad", "3%")], "pos int, item string, reason string, share string")
    out = tracker.tracker_merge(master, source, ["item", "reason"], "share", ["pos"], loose=["item"])
    assert {r.item: r.value for r in out.collect()} == {"Blue ": 3, "Deep-Blue": 12.5, "Green": None}
    a = frame(spark, [("m", 1.0)], "metric string, value double")
    old = tracker.kpi_tracker("p", {"s": a})
    new = tracker.kpi_tracker("p", {"s": a.withColumn("value", F.lit(2)), "t": a})
    assert {(r.section, r.value) for r in tracker.tracker_update(old, new).collect()} == {("s", 2.0), ("t", 1.0)}
