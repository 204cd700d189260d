import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopledger.functions import answers, periods, predicates, scalars


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("build", "value", "expected"),
    [
        (scalars.every_n, "Every 4 weeks (RECO)", 4),
        (scalars.every_n, "Every 2 months", 2),
        (scalars.every_n, "Every", None),
        (scalars.every_n, "Monthly", None),
        (scalars.every_n_weeks, "Every 4 weeks (RECO)", 4),
        (scalars.every_n_weeks, "Every 2 months", None),
        (scalars.every_n_weeks, None, None),
        (scalars.days_as_weeks, "28 days", 4.0),
        (scalars.days_as_weeks, "often", None),
        (scalars.days_as_weeks, None, None),
        (scalars.in_parentheses, "Sub (a) (Every 3 weeks)", "Every 3 weeks"),
        (scalars.reason_root, "a -> b -> c", "a"),
        (scalars.reason_root, "a", "a"),
        (scalars.reason_root, " a ->b", "a"),
        (scalars.reason_root, None, scalars.NO_REASON),
        (scalars.reason_root, "  ", ""),
        (lambda c: scalars.reason_root(c, blank_is_missing=True), "  ", scalars.NO_REASON),
        (lambda c: scalars.reason_root(c, "-"), "too dark - x -> y", "too dark"),
        (lambda c: scalars.word_after(c, "device_id:"), "pi order device_id:abc end", "abc"),
        (lambda c: scalars.word_after(c, "device_id:"), "pi order", None),
        (scalars.first_word, "pi_1 order", "pi_1"),
        (scalars.normalized_status, " paid ", "PAID"),
        (scalars.normalized_status, None, ""),
        (scalars.is_truthy, " TRUE", True),
        (scalars.is_truthy, "y", True),
        (scalars.is_truthy, "no", False),
        (scalars.is_truthy, None, False),
        (scalars.percent_number, "12,3%", 12.3),
        (scalars.percent_number, " 7 %", 7.0),
        (scalars.percent_number, "n/a", None),
        (scalars.lenient_amount, "12.5", 12.5),
        (scalars.lenient_amount, "12.5.1", 12.0),
        (scalars.lenient_amount, "x", None),
        (scalars.step_name, "3. Add to cart", "Add to cart"),
        (scalars.step_number, "3. Add to cart", 3),
        (scalars.decline_code, '{"stripeError":{"error":{"decline_code":"x"}}}', "x"),
        (scalars.decline_code, "{}", "unknown_error"),
        (scalars.decline_code, "not json", "invalid_metadata"),
        (scalars.decline_code, None, "invalid_metadata"),
        (scalars.lookup_key, "Deep-Blue 30 ml", "deepblue30ml"),
        (scalars.blank_to_null, "  ", None),
    ],
)
def test_text_helpers(spark, build, value, expected):
    assert one(spark, value, build) == expected


def test_ratios(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (0, 0), (1, None)], "n int, d int")
    out = [r[0] for r in df.select(scalars.safe_ratio(F.col("n"), F.col("d"))).collect()]
    assert out == [0.25, 0.0, 0.0, 0.0]
    assert one(spark, 12.345, scalars.percent_text, "double").startswith("12.3")
    assert one(spark, None, scalars.percent_text, "double") == ""


def test_first_matching_rule_wins(spark):
    rules = [
        {"type": 7, "prefixes": ["104"]},
        {"type": 9, "codes": ["104X", "ABC"]},
        {"type": 2, "between": (500, 600)},
    ]
    for code, expected in {"104x": 7, " abc ": 9, "500": 2, "600": 2, "601": 1, "5a0": 1, "": 1, None: 1}.items():
        assert one(spark, code, lambda c: scalars.classify(c, rules, 1)) == expected


def test_ids(spark):
    assert one(spark, 7, lambda c: scalars.padded_id("PRT", c, 10), "int") == "PRT0000007"
    assert one(spark, 12, lambda c: scalars.padded_id("PRT", c, 10), "int") == "PRT0000012"
    a, b = (one(spark, v, lambda c: scalars.stable_id("REV", 32, c)) for v in ("x", None))
    assert len(a) == 32 and a.startswith("REV") and a != b
    assert a == one(spark, "x", lambda c: scalars.stable_id("REV", 32, c))


def test_deviation_needs_a_history(spark):
    df = spark.createDataFrame([(0.15, 0.1), (0.13, 0.1), (0.05, 0.1), (0.1, 0.0)], "m double, h double")
    flags = [r[0] for r in df.select(scalars.deviation_flag(scalars.deviation(F.col("m"), F.col("h")))).collect()]
    assert flags == ["high", None, "low", None]


@pytest.mark.parametrize(("bounds", "expected"), [("[)", [1, 2]), ("()", [2]), ("[]", [1, 2, 3])])
def test_period_bounds(spark, bounds, expected):
    rows = [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 15)), (3, dt.datetime(2024, 2, 1)), (4, None)]
    df = spark.createDataFrame(rows, "i int, ts timestamp_ntz")
    inside = df.filter(periods.in_period(F.col("ts"), "2024-01-01", "2024-02-01", bounds))
    assert sorted(r.i for r in inside.collect()) == expected
    with pytest.raises(ValueError):
        periods.in_period(F.col("ts"), "a", "b", "(]")


def test_dates(spark):
    stamp = dt.datetime(2024, 1, 1, 5)
    assert one(spark, stamp, periods.local_date, "timestamp_ntz") == dt.date(2023, 12, 31)
    pair = spark.createDataFrame([(dt.datetime(2024, 1, 3, 1), dt.datetime(2024, 1, 1, 23))], "a timestamp_ntz, b timestamp_ntz")
    a, b = F.col("a"), F.col("b")
    assert tuple(pair.select(periods.calendar_days_between(a, b), periods.elapsed_days_between(a, b)).first()) == (2, 1)
    for text, expected in {
        "2024-01-01T10:00:00Z": dt.datetime(2024, 1, 1, 10),
        "2024-01-01T23:30:00-05:00": dt.datetime(2024, 1, 2, 4, 30),
        "2024-01-01T10:00:00": dt.datetime(2024, 1, 1, 10),
        "2024-01-01": dt.datetime(2024, 1, 1),
        "garbage": None,
        " ": None,
    }.items():
        assert one(spark, text, periods.in_zone_to_utc) == expected, text
    for text, expected in {"2024-01-01": dt.date(2024, 1, 1), "45292": dt.date(2024, 1, 1), "x": None}.items():
        assert one(spark, text, periods.lenient_date) == expected
    assert one(spark, dt.date(2024, 9, 1), periods.month_label, "date") == "sept"


LIST = '{"values":[{"value":14,"variable":4},{"value":118,"variable":40}]}'
OBJECT = '{"values":{"z":{"value":"14","variable":"4"},"a":{"value":"13","variable":"5"}}}'
BARE_LIST = '[{"value":13,"variable":4}]'
BARE_OBJECT = '{"9":{"value":"15","variable":"4"}}'


def test_answers_in_all_shapes(spark):
    read = lambda text: [tuple(r) for r in one(spark, text, lambda c: answers.answer_list(answers.parsed(c)))]
    assert read(LIST) == [(4, "14"), (40, "118")]
    assert read(OBJECT) == [(4, "14"), (5, "13")]
    assert read(BARE_LIST) == [(4, "13")]
    assert read("bad") == [] and read(None) == []
    assert read('[{"value":1,"variable":"x"},{"value":2,"variable":3}]') == []


@pytest.mark.parametrize(
    ("text", "code"), [(LIST, 14), (BARE_LIST, 13), (BARE_OBJECT, 15), (OBJECT, None), ("bad", None), (None, None)]
)
def test_first_code_skips_wrapped_objects(spark, text, code):
    assert one(spark, text, lambda c: answers.first_code(answers.parsed(c), [13, 14, 15])) == code


def test_first_code_can_read_wrapped_objects_in_document_order(spark):
    assert one(spark, OBJECT, lambda c: answers.first_code(answers.parsed(c), [13, 14, 15], wrapped_objects=True)) == 14


def test_precedence(spark):
    wrap = lambda text: f'{{"diagnostic":{text}}}'
    pick = lambda text: one(spark, text, lambda c: answers.code_by_precedence(c, [14, 15, 13]))
    assert pick(wrap('{"values":[{"value":13},{"value":15}]}')) == 15
    assert pick(wrap(OBJECT)) == 14
    assert pick(wrap('{"values":[]}')) is None and pick(None) is None


def test_answer_to_prefers_the_first_variable(spark):
    experience = {"now": ["118", "112"], "never": ["120"]}
    get = lambda text: one(spark, text, lambda c: answers.labelled(answers.answer_to(answers.parsed(c), [40, 36]), experience))
    assert get('[{"variable":36,"value":120},{"variable":40,"value":118}]') == "now"
    assert get('[{"variable":36,"value":120}]') == "never"
    assert get('[{"variable":40,"value":null},{"variable":36,"value":120}]') == "Unknown"
    assert get(None) == "Unknown"


def test_filters_as_data(spark):
    df = spark.createDataFrame([(1, "a", "5"), (2, None, "10"), (3, "b", None)], "i int, s string, n string")
    ids = lambda filters: [r.i for r in df.filter(predicates.build_predicate(df, filters)).orderBy("i").collect()]
    assert ids(None) == [1, 2, 3]
    assert ids({"s": "a"}) == [1]
    assert ids({"s": {"op": "ne", "value": "a"}}) == [2, 3]
    assert ids({"s": {"op": "isna"}}) == [2]
    assert ids({"s": {"op": "notna"}, "i": {"op": "gt", "value": 1}}) == [3]
    assert ids({"s": {"op": "in", "values": ["a", "b"]}}) == [1, 3]
    assert ids({"n": {"op": "gte", "value": 10}}) == [2]
    assert ids({"n": {"op": "lt", "value": 10}}) == [1]
    assert ids({"i": {"op": "lte", "value": 2}}) == [1, 2]
    assert ids({"i": {"op": "eq", "value": 3}}) == [3]
    with pytest.raises(ValueError):
        ids({"i": {"op": "like", "value": 1}})
    with pytest.raises(ValueError):
        predicates.require_columns(df, ["missing"])
    with pytest.raises(ValueError):
        predicates.require_valid(df, "s", ["i"])
    assert predicates.require_valid(df, "i", ["i"]) is df


def test_entries_may_use_short_keys(spark):
    text = '{"values":[{"var":"40","val":"118"},{"variable":36,"value":"116"}]}'
    assert one(spark, text, lambda c: answers.answer_to(answers.parsed(c), [40, 36])) == "118"
    assert [tuple(r) for r in one(spark, text, lambda c: answers.answer_list(answers.parsed(c)))] == [(40, "118"), (36, "116")]
