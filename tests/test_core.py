"""The order-following blocks against brute force, with one key holding most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shopledger.operators import core

T0 = dt.datetime(2024, 1, 1)


def hot_rows(n=400, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(6)}"
        ts = None if rng.random() < 0.03 else T0 + dt.timedelta(hours=rng.randrange(6 * 24 * 3) / 6)
        rows.append((i, key, ts, rng.choice("abc")))
    return rows


def sort_key(row):
    return (row[2] is not None, row[2] or T0, row[0])


def test_numbered_counts_on_over_hours(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "id int, key string, ts timestamp_ntz, v string")
    out = core.numbered(df, ["key"], "ts", ["id"], "n", ["v"]).collect()
    expected = {}
    first = {}
    for key in {r[1] for r in rows}:
        ordered = sorted((r for r in rows if r[1] == key), key=sort_key)
        first[key] = ordered[0][3]
        expected |= {r[0]: i + 1 for i, r in enumerate(ordered)}
    assert {r.id: r.n for r in out} == expected
    assert {r.key: r.first_v for r in out} == first


def changes_by_hand(rows):
    expected = {}
    for key in {r[1] for r in rows}:
        ordered = sorted((r for r in rows if r[1] == key), key=sort_key)
        values = {r[3] for r in ordered if r[3] is not None}
        before = None
        for r in ordered:
            if before is None or (r[3] is not None and r[3] != before):
                expected[r[0]] = (r[1], r[3], before, len(values) > 1)
            before = r[3]
    return expected


@pytest.mark.parametrize("values", ["abc", "aaaaaaaab", "a", ["a", "b", None]])
def test_change_points_cross_hours(spark, values):
    rng = random.Random(5)
    rows = [(*r[:3], rng.choice(values)) for r in hot_rows()]
    df = spark.createDataFrame(rows, "id int, key string, ts timestamp_ntz, v string")
    out = core.change_points(df, ["key"], "ts", ["id"], "v", "prev")
    assert {r.id: (r.key, r.v, r.prev, r.several) for r in out.collect()} == changes_by_hand(rows)
    assert core.change_points(df.limit(0), ["key"], "ts", ["id"], "v", "prev").count() == 0


def test_last_before_is_strict_and_takes_the_highest_tie(spark):
    facts = [r for r in hot_rows(300, 1)]
    events = [(1000 + r[0], r[1], r[2]) for r in hot_rows(300, 2)]
    f = spark.createDataFrame(facts, "id int, key string, at timestamp_ntz, v string")
    e = spark.createDataFrame(events, "event int, key string, ts timestamp_ntz")
    out = core.last_before(e, f, "key", "ts", "at", ["id"], ["id", "v"]).collect()
    expected = {}
    for event, key, ts in events:
        before = [r for r in facts if ts and r[1] == key and r[2] and r[2] < ts]
        if before:
            best = max(before, key=lambda r: (r[2], r[0]))
            expected[event] = (best[0], best[3])
    assert {r.event: (r.id, r.v) for r in out} == expected


def test_last_before_drops_facts_at_the_same_instant(spark):
    f = spark.createDataFrame([("k", T0, 1)], "key string, at timestamp_ntz, id int")
    e = spark.createDataFrame([("k", T0, 1), ("k", T0 + dt.timedelta(seconds=1), 2)], "key string, ts timestamp_ntz, event int")
    out = core.last_before(e, f, "key", "ts", "at", ["id"], ["id"])
    assert [r.event for r in out.collect()] == [2]


def test_latest_two(spark):
    rows = [r for r in hot_rows() if r[2] is not None]
    df = spark.createDataFrame(rows, "id int, key string, ts timestamp_ntz, v string")
    out = {r.key: (r.last_ts, r.second_last_ts) for r in core.latest_two(df, ["key"], "ts", "id").collect()}
    for key, pair in out.items():
        ordered = sorted((r[2] for r in rows if r[1] == key), reverse=True)
        assert pair == (ordered[0], ordered[1] if len(ordered) > 1 else None)


def test_top_two_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_rows(), "id int, key string, ts timestamp_ntz, v string")
    plan = core.latest_two(df, ["key"], "ts", "id")._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan


def test_totals_and_means_over_listed_days(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 3), 4)], "day date, n int")
    out = {r.label: r.n for r in core.with_totals(df, ["n"], mean=True).collect()}
    assert out == {"2024-01-01": 2, "2024-01-03": 4, "Total": 6, "Mean": 3}
    empty = core.with_totals(df.filter("n > 99"), ["n"]).collect()
    assert empty == []


@pytest.mark.parametrize(
    ("value", "expected"),
    [(-0.01, None), (0, 0), (20, 0), (20.01, 1), (35, 1), (36, 2), (None, None)],
)
def test_bins_are_closed_on_the_right(spark, value, expected):
    df = spark.createDataFrame([(value if value is None else float(value),)], "x double")
    assert df.select(core.bin_of(F.col("x"), [0, 20, 35])).first()[0] == expected


def test_value_counts_ignores_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string")
    assert [tuple(r) for r in core.value_counts(df, "x").collect()] == [("b", 2), ("a", 1)]


@pytest.mark.parametrize("step", ["missing", "day"])
def test_hot_key_without_times_or_with_whole_days(spark, monkeypatch, step):
    monkeypatch.setattr(core, "_TIES_PER_SLOT", 7)
    rng = random.Random(11)
    ids = rng.sample(range(-200, 400), 300)
    rows = [(i, "hot", None if step == "missing" and i % 3 else T0 + dt.timedelta(days=i % 4), rng.choice("abc")) for i in ids]
    df = spark.createDataFrame(rows, "id int, key string, ts timestamp_ntz, v string")
    ordered = sorted(rows, key=sort_key)
    out = core.numbered(df, ["key"], "ts", ["id"], "n", ["v"]).collect()
    assert {r.id: r.n for r in out} == {r[0]: i + 1 for i, r in enumerate(ordered)}
    assert {r.first_v for r in out} == {ordered[0][3]}
    out = core.change_points(df, ["key"], "ts", ["id"], "v", "prev").collect()
    assert {r.id: (r.key, r.v, r.prev, r.several) for r in out} == changes_by_hand(rows)
