import json

import pytest

from shopledger.operators.reviews import review_load_set
from shopledger.operators.tracker import kpi_tracker
from shopledger.plans.queries import payment_attempt_file
from shopledger.sources import readers, sinks
from shopledger.sources.catalog import Catalog


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_catalog_prefers_builders(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    catalog = Catalog(spark, str(tmp_path), {"twice": lambda c: c.table("t").union(c.table("t"))})
    assert (catalog.table("t").count(), catalog.table("twice").count()) == (3, 6)


def test_funnel_export_with_preamble(spark, tmp_path):
    lines = ["# comment"] * 9 + ['Day,"1. View, all",2. Cart,Ingreso Active users', "1,10,5,8", "2,4,,8", ""]
    steps = readers.read_funnel_csv(spark, write(tmp_path / "f.csv", "\r\n".join(lines)), "shop")
    assert {(r.day, r.step_no, r.step, r.users) for r in steps.collect()} == {
        (1, 1, "View, all", 10),
        (1, 2, "Cart", 5),
        (2, 1, "View, all", 4),
        (2, 2, "Cart", None),
    }


def test_funnel_exports_with_headers_of_their_own(spark, tmp_path):
    start = ["# comment"] * 9
    write(tmp_path / "one.csv", "\n".join([*start, "Day,1. View,2. Cart", "1,10,5"]))
    write(tmp_path / "two.export.csv", "\n".join([*start, "3. Buy,Day", "7,2", " ", "8,3", ""]))
    (tmp_path / "funnel=three").mkdir()
    write(tmp_path / "funnel=three" / "part-0.csv", "\r\n".join([*start, 'Day,"1. A, b",Ingreso Active users', "4,9,1"]))
    steps = readers.read_funnel_csv(spark, str(tmp_path))
    assert {(r.funnel, r.day, r.step_no, r.step, r.users) for r in steps.collect()} == {
        ("one", 1, 1, "View", 10),
        ("one", 1, 2, "Cart", 5),
        ("two", 2, 3, "Buy", 7),
        ("two", 3, 3, "Buy", 8),
        ("three", 4, 1, "A, b", 9),
    }
    write(tmp_path / "short.csv", "only this line")
    with pytest.raises(ValueError):
        readers.read_funnel_csv(spark, str(tmp_path))


def test_payment_files(spark, tmp_path):
    blocked = write(
        tmp_path / "b.csv",
        "customer_id,payment_intent_id,description,amount,rule_decision_created\nc1,p1,o1 x,5.5,2024-01-01 10:00:00\nc2,p2,o2,bad,\n",
    )
    rows = readers.read_blocked_payments(spark, blocked).orderBy("row_no").collect()
    assert [(r.customer_id, r.amount) for r in rows] == [("c1", 5.5), ("c2", None)]
    paid = write(tmp_path / "p.csv", "Description,Status,Amount,More\no1 x,Paid,5.5,z\n")
    assert readers.read_processor_payments(spark, paid).first().amount == 5.5
    header = "Description,Customer Email,Status,Created date (UTC),Card ID\n"
    attempts = write(tmp_path / "a.csv", header + "niño,user1@example.com,Paid,2024-01-01 10:00:00,c\n", "latin-1")
    row = readers.read_payment_attempts(spark, attempts, "ISO-8859-1").first()
    assert row.description == "niño" and row.created_utc.hour == 10
    with pytest.raises(ValueError):
        readers.read_payment_attempts(spark, paid)


def test_attempts_of_one_second_keep_their_order(spark, tmp_path):
    header = "Description,Customer Email,Status,Created date (UTC),Card ID\n"
    times = ["2024-01-01 10:00:00", "2024-01-01 10:00:00.5", "2024-01-01 10:00:00.123456", "2024-01-01"]
    file = write(tmp_path / "a.csv", header + "".join(f"d,u,Paid,{t},c\n" for t in times))
    read = readers.read_payment_attempts(spark, file)
    assert [r.created_utc and r.created_utc.microsecond for r in read.collect()] == [0, 500000, 123456, None]
    rows = [("Paid", "00.100000", "card2"), ("Paid", "00.200000", "card1"), ("Failed", "00.900000", "card0")]
    rows = spark.createDataFrame([("d", "u", s, f"2024-01-01 10:00:{t}", c) for s, t, c in rows], "description string, customer_email string, status string, created_utc string, card_id string")
    rows = rows.withColumn("created_utc", rows.created_utc.cast("timestamp_ntz"))
    got = payment_attempt_file(Catalog(spark, "", {"payment_attempts": lambda c: rows})).first()
    assert (got.paid_card_id, got.resolved, got.last_attempt.microsecond) == ("card1", False, 900000)


def test_reviews_document(spark, tmp_path):
    doc = {"itemsList": [{"title": "t", "feedback": {"rating": 5, "adminStatus": "VERIFIED"}}, {"title": "u", "feedback": None}]}
    rows = readers.read_reviews(spark, write(tmp_path / "r.json", json.dumps(doc, indent=1))).collect()
    assert [(r.title, r.feedback and r.feedback.rating) for r in rows] == [("t", "5"), ("u", None)]


def enriched(spark, tmp_path, rating):
    text = f' SKU ,overallRating,Date,comment\nk1,{rating},2024-01-01,"two\nlines"\n'
    return readers.read_enriched_reviews(spark, write(tmp_path / f"e{rating}.csv", text))


def test_reviews_load_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "reviews")
    good = review_load_set(enriched(spark, tmp_path, 5), [], {}, "", "me")
    assert good.first().comment == "two\nlines"
    sinks.load_reviews(good, target)
    with pytest.raises(ValueError):
        sinks.load_reviews(review_load_set(enriched(spark, tmp_path, "x"), [], {}, "", "me"), target)
    assert sinks.loaded_reviews(spark, target).count() == 1


def test_reports_and_kpis_are_replaced(spark, tmp_path):
    folder = str(tmp_path / "report")
    for n in (3, 2):
        sinks.write_report({"a": spark.range(n)}, folder)
    assert sinks.read_report(spark, folder, "a").count() == 2
    sinks.write_report({"a": spark.range(2)}, folder + "-csv", "csv")
    path = str(tmp_path / "kpis")
    one = spark.createDataFrame([("m", 1.0)], "metric string, value double")
    two = spark.createDataFrame([("m", 2.0)], "metric string, value double")
    for period, table in (("p", one), ("q", one), ("p", two)):
        sinks.write_kpis(kpi_tracker(period, {"s": table}), path)
    assert {(r.period, r.value) for r in sinks.read_kpis(spark, path).collect()} == {("p", 2.0), ("q", 1.0)}
