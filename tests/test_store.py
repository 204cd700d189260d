"""Stored tables that change by commits: keyed merges, loads that repeat, writers in each other's way."""

import json

import pytest

from shopledger.operators.tracker import kpi_tracker
from shopledger.plans.fixtures import catalog
from shopledger.plans.queries import kpi_tracker_store, kpi_tracker_update
from shopledger.sources import sinks
from shopledger.sources.catalog import Catalog
from shopledger.sources.store import StagedCatalog, Store, run_folder, shared_folder


def figures(spark, **values):
    return spark.createDataFrame(list(values.items()), "metric string, value double")


def tracked(spark, path):
    return {(r.period, r.section, r.metric): r.value for r in sinks.read_kpis(spark, path).collect()}


def test_a_section_leaves_the_others_alone(spark, tmp_path):
    path = str(tmp_path / "kpis")
    assert sinks.read_kpis(spark, path) is None
    sinks.write_kpis(kpi_tracker("may", {"a": figures(spark, x=1.0, y=2.0), "b": figures(spark, x=3.0)}), path)
    sinks.write_kpis(kpi_tracker("june", {"a": figures(spark, x=4.0)}), path)
    sinks.write_kpis(kpi_tracker("may", {"a": figures(spark, y=20.0), "c": figures(spark, z=5.0)}), path)
    assert tracked(spark, path) == {
        ("may", "a", "x"): 1.0,
        ("may", "a", "y"): 20.0,
        ("may", "b", "x"): 3.0,
        ("may", "c", "z"): 5.0,
        ("june", "a", "x"): 4.0,
    }
    with pytest.raises(ValueError):
        sinks.write_kpis(figures(spark, x=1.0).union(figures(spark, x=2.0)).selectExpr("'may' AS period", "'a' AS section", "*"), path)
    number, state = Store(spark, path, "period").state()
    assert number == 3 and set(state["parts"]) == {"may", "june"}


def rows(spark, *ids):
    return spark.createDataFrame([(i, f"v{i}") for i in ids], "id int, v string")


def test_readers_see_whole_commits_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    assert store.commit("one", lambda present: rows(spark, 1, 2))
    rows(spark, 99).write.parquet(str(tmp_path / "t" / "data" / "commit=lost"))  # a writer that died
    (tmp_path / "t" / "_commits" / "0000000002.json").write_text('{"parts": {"x"')  # one that is writing
    assert sorted(r.id for r in store.read().collect()) == [1, 2]
    assert store.read().columns == ["id", "v"]


def test_a_batch_is_taken_in_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    assert store.commit("one", lambda present: rows(spark, 1))
    assert not store.commit("one", lambda present: rows(spark, 1))
    assert store.commit(None, lambda present: rows(spark, 2))
    assert sorted(r.id for r in store.read().collect()) == [1, 2]


def test_a_writer_that_loses_starts_over(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second, seen = Store(spark, path), Store(spark, path), []

    def slow(present):
        known = present(None)
        seen.append(sorted(r.id for r in known.collect()) if known is not None else [])
        if len(seen) == 1:
            second.commit(None, lambda _: rows(spark, 1))
        return rows(spark, 10 + len(seen))

    assert first.commit(None, slow)
    assert seen == [[], [1]]
    assert sorted(r.id for r in first.read().collect()) == [1, 12]
    names = sorted(p.name for p in (tmp_path / "t" / "_commits").glob("*.json"))
    assert names == ["0000000001.json", "0000000002.json"]
    assert len(json.loads((tmp_path / "t" / "_commits" / names[1]).read_text())["parts"]) == 2


def test_empty_commits_and_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), "v")
    assert store.commit("none", lambda present: rows(spark).limit(0)) and store.read() is None
    assert store.commit("some", lambda present: rows(spark, 1)) and store.read().count() == 1


def reviews(spark, *ids):
    data = [(f"REV{i}", "me", 5, "2024-01-01 00:00:00", f"text {i}") for i in ids]
    return spark.createDataFrame(data, "id string, created_by string, overall_rating int, review_date string, comment string")


def test_loading_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "reviews")
    assert sinks.load_reviews(reviews(spark, 1, 2, 2), path)
    assert sinks.load_reviews(reviews(spark, 2, 3), path, "b")
    assert not sinks.load_reviews(reviews(spark, 2, 3, 4), path, "b")
    assert sinks.load_reviews(reviews(spark, 1, 2, 3), path)
    assert sorted(r.id for r in sinks.loaded_reviews(spark, path).collect()) == ["REV1", "REV2", "REV3"]


def test_staged_tables_are_written_once(spark, tmp_path):
    built = []

    def table(c):
        built.append(1)
        return c.spark.range(5).selectExpr("id", "id * 2 AS twice", "'x' AS rest")

    base = Catalog(spark, str(tmp_path), {"t": table, "over": lambda c: c.table("t").select("id")})
    for _ in range(2):
        staged = StagedCatalog(base, str(tmp_path / "may"), {"t": ["id", "twice"]})
        assert staged.table("t").columns == ["id", "twice"] and staged.table("over").count() == 5
    assert len(built) == 1
    (tmp_path / "may" / "t" / "_SUCCESS").unlink()  # a run that failed in between
    assert staged.table("t").count() == 5 and len(built) == 2


def test_run_folders_are_new(spark):
    assert run_folder(spark, "a") != run_folder(spark, "a")
    assert shared_folder(spark)


def counted(spark, df):
    """The rows, and a number that grows by one whenever one of them is computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_figures_are_computed_once(spark, tmp_path):
    path = str(tmp_path / "kpis")
    for _ in range(2):
        kpis, seen = counted(spark, kpi_tracker("may", {"a": figures(spark, x=1.0, y=2.0)}))
        sinks.write_kpis(kpis, path)
        assert seen.value == 2
    assert [p.name for p in tmp_path.iterdir()] == ["kpis"]


@pytest.mark.parametrize("query", [kpi_tracker_store, kpi_tracker_update])
def test_tracker_computes_a_section_once(spark, data, query):
    tables = catalog(spark, data)
    groups, seen = counted(spark, tables.table("items_item_groups"))
    tables.builders["items_item_groups"] = lambda c: groups
    rows = groups.count()
    before = seen.value
    assert query(tables).count() == 16 and before == rows
    assert seen.value - before == rows
